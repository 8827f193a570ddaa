import zlib

import numpy as np

from concordat.llm import quality_classifier as q


def corpus(prose):
    rows, labels = [], []
    for i in range(240):
        bad = i % 4 == 1
        text = prose(i, 30 + i % 50, 3000)
        rows.append((i, " ".join(w + "***" for w in text.split()) if bad else text + "."))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_held_out_rows(spark, docs, prose):
    rows, labels = corpus(prose)
    marked = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in q.score(docs(*rows), marked).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert all(r.predicted == label and (r.score >= 0.7) == bool(label) for i, label, _ in labels for r in (found[i],))
    kept = {r.doc_id for r in q.keep(docs(*rows), marked).collect()}
    assert kept == {i for i, r in found.items() if r.predicted}


def test_density_against_plain_formula():
    draw = np.random.default_rng(1)
    d = len(q.FEATURES)
    x = {c: draw.normal(c, 1 + c, (200, d)) for c in (0, 1)}
    model = q.solve({c: (200.0, v.sum(axis=0), v.T @ v) for c, v in x.items()})
    z = (x[1][:5] - model.centre) / model.scale
    for k in range(5):
        logs = []
        for c in (0, 1):
            cov = model.factors[c] @ model.factors[c].T
            diff = z[k] - model.means[c]
            logs.append(-0.5 * np.log(np.linalg.det(cov)) - 0.5 * diff @ np.linalg.inv(cov) @ diff + np.log(0.5))
        assert abs(model.log_odds(x[1][k : k + 1])[0] - (logs[1] - logs[0])) < 1e-6


def test_edges(spark, clashing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(None, "a b"), (1, None), (2, ""), (2, ""), (3, "x" * 100000), (4, " \n\t\x1f")]
    found = q.score(clashing(*rows), none).collect()
    assert len(found) == 6 and all(r.score == 0.5 and r.predicted == 0 for r in found)
    one = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in q.score(clashing(*rows), one).collect())
    assert q.score(clashing(*rows).limit(0), one).count() == 0
    df = clashing(*rows)
    assert q.keep(df, one).columns == df.columns
