"""Files with unknown separators, encodings, preambles and parts."""

import uuid

from concordat.sources import columns as sc
from concordat.sources import files as fs
from concordat.sources import state as st


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_separator_encoding_and_bom(spark, tmp_path):
    a = fs.read_csv_snapshot(spark, put(tmp_path, "a.csv", "nom;ville\nDupré;Orléans\n", "latin-1"))
    b = fs.read_csv_snapshot(spark, put(tmp_path, "b.csv", "﻿nom\tville\nDupré\tOrléans\n"))
    c = fs.read_csv_snapshot(spark, put(tmp_path, "c.csv", 'nom,ville\n"Dupré",Orléans\n'))
    for df in (a, b, c):
        assert df.columns == ["nom", "ville"] and [tuple(r) for r in df.collect()] == [("Dupré", "Orléans")]


def test_preamble(spark, tmp_path):
    path = put(tmp_path, "p.csv", "extrait du jour\n\nnom;ville\nA;B\nC;D\n")
    df = fs.read_csv_snapshot(spark, path, sep=";", encoding="utf-8", preamble=1)
    assert sorted(tuple(r) for r in df.collect()) == [("A", "B"), ("C", "D")]


def test_preamble_only_at_the_head_of_each_file(spark, tmp_path):
    """Rows equal to the header or to a preamble line are rows; each of many files has a head of its own."""
    want = []
    for i in range(40):
        rows = [f"{i};{k}" for k in range(5)] + ["nom;ville", "Extrait;du jour"]
        put(tmp_path, f"p{i:02}.csv", "\n".join(["Extrait;du jour", "", "nom;ville", *rows]) + "\n")
        want += [tuple(r.split(";")) for r in rows]
    for splits in ("128m", "64"):  # also with every file in several splits
        spark.conf.set("spark.sql.files.maxPartitionBytes", splits)
        try:
            df = fs.read_csv_snapshot(spark, str(tmp_path), preamble=1)
            assert df.columns == ["nom", "ville"]
            assert sorted(tuple(r) for r in df.collect()) == sorted(want)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def jobs_of(spark, work):
    """Number of Spark jobs that a call starts."""
    sc = spark.sparkContext
    group = uuid.uuid4().hex
    sc.setJobGroup(group, group)
    try:
        out = work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return out, len(sc.statusTracker().getJobIdsForGroup(group))


def test_parts_need_the_same_jobs_for_one_file_and_for_500(spark, tmp_path):
    counts = []
    for n in (1, 500):
        folder = tmp_path / f"n{n}"
        folder.mkdir()
        for i in range(n):
            sep, name, text = ((",", "a", "Dupré"), (";", "b", "Lœuf"))[i % 2]
            put(folder, f"Part{i}.csv", f"id{sep}{name}\n{i}{sep}{text}\n{i}{sep}z\n")

        def read(folder=folder):
            return fs.union_parts(spark, str(folder), "Part*.csv")

        df, jobs = jobs_of(spark, read)
        counts.append(jobs)
        assert df.count() == 2 * n
        assert {r["a"] for r in df.collect()} - {None} == {"Dupré", "z"}
    assert counts[0] == counts[1] > 0, counts


def test_parts_of_several_encodings(spark, tmp_path):
    put(tmp_path, "Part1.csv", "nom,ville\nDupré,Orléans\n", "latin-1")
    put(tmp_path, "Part2.csv", "\ufeffnom,ville\nDupré,Orléans\n")
    put(tmp_path, "Part3 é.csv", 'ville,nom,nom\n"Or,l",A,B\n')
    got = sorted(map(str, (tuple(r.asDict().items()) for r in fs.union_parts(spark, str(tmp_path), "Part*.csv").collect())))
    assert len(got) == 3 and sum("('nom', 'Dupré'), ('ville', 'Orléans')" in g for g in got) == 2
    assert "('nom1', 'A')" in got[-1] + got[0] + got[1] and "('nom2', 'B')" in got[-1] + got[0] + got[1]


def test_wrapped_lines(spark, tmp_path):
    df = fs.read_wrapped_csv(spark, put(tmp_path, "w.csv", '"nom;ville"\n"""A"";B"\n"C;""D;E"""\n'))
    assert sorted(tuple(r) for r in df.collect()) == [("A", "B"), ("C", "D;E")]


def test_parts_with_exclusion(spark, tmp_path):
    put(tmp_path, "01012024_TP_GED_1.csv", "idepsp,x\nK1,1\n")
    put(tmp_path, "01012024_TP_GED_2.csv", "idepsp;y\nK2;2\n")
    put(tmp_path, "01012024_TP_GED_RETRY.csv", "idepsp,x\nK9,9\n")
    df = fs.union_parts(spark, str(tmp_path), "01012024_TP_GED*.csv", exclude="RETRY")
    assert sorted((r["idepsp"], r["x"], r["y"]) for r in df.collect()) == [("K1", "1", None), ("K2", None, "2")]


def test_source_tag(spark, tmp_path):
    put(tmp_path, "17072024_IEHE_KO.csv", "a\n1\n")
    row = fs.tag_source_file(spark.read.option("header", "true").csv(str(tmp_path / "17072024_IEHE_KO.csv"))).first()
    assert (row["source_file"], row["flux_id"], str(row["flux_date"])) == ("17072024_IEHE_KO.csv", "17072024", "2024-07-17")


def test_alias_resolution(rows):
    df = rows("`Num_Personne ` string, nom string, nom_long string, `Prénom` string", ("1", "second", "first", "P"))
    wanted = {k: sc.MEMBER_ALIASES[k] for k in ("person_id", "last_name", "first_name", "offer")}
    assert tuple(sc.resolve_columns(df, wanted).first()) == ("1", "first", "P", None)
    assert sc.storage_header("Date-d'émission. x") == "date_demission_x"


def test_replace_flux_twice_and_schema_growth(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    st.replace_flux(rows("a long", (1,), (2,)), path, "01022024", "2024-02-01")
    st.replace_flux(rows("a long", (7,)), path, "02022024", "2024-02-02")
    for _ in range(2):
        st.replace_flux(rows("a long, b string", (3, "n")), path, "01022024", "2024-02-03")
    got = sorted((r["flux_id"], r["a"], r["b"]) for r in st.read_table(spark, path).collect())
    assert got == [("01022024", 3, "n"), ("02022024", 7, None)]


def test_preamble_keeps_rows_with_empty_fields(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    with open(path, "w", encoding="utf-8") as out:
        out.write("﻿Extract of the day;;\n\nid;mail;code\n1;a@b.fr;X\n2;;Y\n;c@d.fr;Z\n;;\n\"3;4\";\"q\"\"q\";\n")
    df = fs.read_csv_snapshot(spark, path, sep=";", encoding="utf-8", preamble=1)
    assert df.columns == ["id", "mail", "code"]
    got = [tuple(r) for r in df.collect()]
    assert got == [("1", "a@b.fr", "X"), ("2", None, "Y"), (None, "c@d.fr", "Z"), (None, None, None), ("3;4", 'q"q', None)]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from concordat.session import checkpoint_dir

    def session(master, folder=None):
        empty = SimpleNamespace(get=lambda *_: None)
        context = SimpleNamespace(master=master, getConf=lambda: empty, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=context)

    assert checkpoint_dir(session("spark://host:7077", "hdfs://x/y")) == "hdfs://x/y"
    assert checkpoint_dir(session("local[8]"))
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            checkpoint_dir(session(master))
