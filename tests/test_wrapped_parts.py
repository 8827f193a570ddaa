"""Extracts of lines quoted as a whole, in several parts."""

from concordat.sources import files as fs


def test_header_of_the_first_file_and_of_no_other_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"nom;ville"\n"A;B"\n"nom;Lyon"\n', encoding="utf-8")
    (tmp_path / "b.csv").write_text("".join(f'"B{i};""x;{i}"""\n' for i in range(50)), encoding="utf-8")
    (tmp_path / "c.csv").write_text('"nom;ville"\n"C;D"\n', encoding="utf-8")
    df = fs.read_wrapped_csv(spark, str(tmp_path))
    assert df.columns == ["nom", "ville"]
    assert sorted(tuple(r) for r in df.collect()) == sorted([("A", "B"), ("nom", "Lyon"), ("C", "D"), *((f"B{i}", f"x;{i}") for i in range(50))])
