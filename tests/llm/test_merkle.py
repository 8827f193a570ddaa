import hashlib
import random

from pyspark.sql import functions as F

from concordat.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def tree(nodes):
    """Root of a list of digests and the steps ``(left, right)`` of every leaf."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = nodes[a - a % 16 : a - a % 16 + 16]
            steps[i].append(("".join(run[: a % 16]), "".join(run[a % 16 + 1 :])))
        nodes = [h(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
        at = [a // 16 for a in at]
    return nodes[0], steps


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0, leaf(r)), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    found = {}
    for s in names:
        group = sorted(by_source[s], key=lambda x: x[0])
        found[s] = (group, *tree([k[2] for k, _ in group]))
    root, tops = tree([found[s][1] for s in names])
    out = []
    for s, top in zip(names, tops, strict=True):
        group, subroot, steps = found[s]
        out += [(r[0], k[2], subroot, root, h(*(x + y for x, y in own + top))) for (k, r), own in zip(group, steps, strict=True)]
    return out


def manifest(df):
    found = merkle.manifest(df).withColumn("folded", merkle.fold(F.col("leaf"), F.col("proof")))
    rows = found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("p"), "folded").collect()
    assert all(r.folded == r.root for r in rows)
    return [tuple(r)[:5] for r in rows]


def order(rows):
    return sorted(rows, key=str)


def test_against_brute_force(spark):
    draw = random.Random(5)
    rows = []
    for s, n in (("a", 1), ("b", 16), ("B", 17), (None, 40), ("é", 300), ("~", 5000)):
        ids = draw.sample(range(-200_000, 200_000), n)
        rows += [(i, s, "en", 3, f"Text {i} Ü") for i in ids]
    rows += [(i, "huge", None, None, None) for i in (2**62, -(2**62), -1, 0, 63, 64, 65_535, 65_536, 2**63 - 1, -(2**63))]
    draw.shuffle(rows)
    assert order(manifest(spark.createDataFrame(rows, SCHEMA).repartition(5))) == order(brute(rows))


def test_repeated_rows_and_null_ids(spark):
    rows = [(7, "s", "en", 1, "x")] * 20 + [(7, "s", "en", 1, f"y{i}") for i in range(5)] + [(8, "s", "en", 1, "z"), (6, "s", "en", 1, "z")]
    rows += [(None, "s", "en", 1, f"n{i}") for i in range(30)] + [(None, "s", "en", 1, "n0")] * 2 + [(7, None, "en", 1, "x")]
    assert order(manifest(spark.createDataFrame(rows, SCHEMA).repartition(4))) == order(brute(rows))


def test_one_source_one_leaf_and_nothing(spark):
    one = [(1, "s", "en", 1, "")]
    assert manifest(spark.createDataFrame(one, SCHEMA)) == brute(one)
    many = [(i, "s", "en", 1, "t") for i in range(33)]
    assert order(manifest(spark.createDataFrame(many, SCHEMA))) == order(brute(many))
    apart = [(i, f"s{i}", "en", 1, "t") for i in range(40)]
    assert order(manifest(spark.createDataFrame(apart, SCHEMA))) == order(brute(apart))
    assert manifest(spark.createDataFrame([], SCHEMA)) == []


def test_clashing_columns_and_tampering(spark):
    rows = [(i, "s", "en", 4, "Long " * 50_000 if i == 3 else f"T{i}") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("group", "pos", "digest", "shown", "word", "bit", "rank", "n", "proof", "chunk"):
        df = df.withColumn(name, F.lit("x"))
    assert order(manifest(df)) == order(brute(rows))
    fields = [merkle.lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS]
    found = merkle.manifest(df, shown=merkle.leaf_digest(fields))
    assert found.where(merkle.fold(F.col("shown"), F.col("proof")) == F.col("root")).count() == 0


def test_lower_ascii(spark):
    assert spark.range(1).select(merkle.lower_ascii(F.lit("AZ Éİ z"))).first()[0] == "az Éİ z"
