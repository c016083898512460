from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline as P
from tests.llm.conftest import document, prose, rows
from tests.llm.test_minhash import brute as groups
from tests.llm.test_mixing import brute as mix
from tests.llm.test_quality import brute as judged
from wardlog.llm import gru

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, `key` string, id string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of every kind a stage acts on, with extra columns; the last half of the toxic ones has no label."""
    path, docs, labels = tmp_path_factory.mktemp("pipeline"), [], []
    for n in range(240):
        text = prose(n, 40 + n % 30)
        if n % 4 == 0:
            text = " ".join(w + (" grubble snorfel" if k % 9 == 3 else "") for k, w in enumerate(text.split()))
        docs.append(document(n, text, f"s{n % 5}"))
        if n < 160:
            labels.append((n, 1, int(n % 4 == 0)))
    docs += [document(1000 + n, prose(n * 4 + 1, 40 + (n * 4 + 1) % 30) + " tail", "s1") for n in range(20)]  # near copies
    docs += [document(2000, prose(1, 41), None), document(2001, "$$$ " * 40), document(2002, None), document(2003, ""), (None, prose(999), None, None, None, None, None, None, None)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_against_brute_force(spark, folder, tmp_path):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for n, (name, stage) in enumerate(P.STAGES):
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        kept[n] = before, [tuple(r) for r in docs.collect()]
        assert n == 4 or docs.columns == columns
    before, after = kept[0]
    assert Counter(after) == Counter(r for r in before if judged(r[1])[-1])
    before, after = kept[1]
    assert Counter(after) == Counter(r for r in before if "grubble" not in r[1])
    before, after = kept[2]
    stay = {g[0] for g in groups([(r[0], r[1]) for r in before], 5) if g[3]}
    assert Counter(after) == Counter(r for r in before if r[0] in stay) and len(after) < len(before)
    before, after = kept[3]
    copies = mix([(r[0], r[1], r[3]) for r in before])
    count = {(u[0], u[1]): sum(c[0]) for u, c in copies.items()}
    assert Counter(after) == Counter({r: count[(r[0], r[3])] for r in before if count[(r[0], r[3])]})
    before, after = kept[4]
    assert Counter((r[0], r[1]) for r in after) == Counter((r[0], k) for r in before for k in (0, 1))


def test_run_is_the_stages(spark, folder):
    found = P.run(spark, folder)
    assert found.columns == ["doc_id", "sample", "ids", "log_prob", "inclusion"]
    assert found.count() > 200


def test_edge_rows_pass_every_stage(spark, edge, nothing, folder, monkeypatch):
    monkeypatch.setattr(P, "train_toxicity", lambda docs, labels: gru.train(["bad word", "good word here"] * 4, [1, 0] * 4))
    for _, stage in P.STAGES:
        assert stage(spark, nothing, folder).count() == 0
        found = stage(spark, edge, folder)
        assert found.count() <= 3 * edge.count()
    assert pa.__version__ and rows(P.quality(spark, edge.limit(0), folder)) == []
