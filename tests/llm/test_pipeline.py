"""The pipeline, stage by stage, against brute force on each stage's own input."""

import random
import re

import pytest

import corpus_pipeline
from tests.llm.test_corpus import components, lowered, shingles

RNG = random.Random(8)
WORDS = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 8))) for _ in range(600)]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    item = words(30)
    texts, quality = [None, ""], {}
    for i in range(2, 240):
        if i % 6 == 0:
            texts.append(" ".join(w.upper() + "!!" for w in words(40).split()))
        elif i % 11 == 0:
            texts.append(texts[-1])
        elif i % 13 == 0:
            texts.append(f"{texts[-2]} {words(2)}")
        elif i % 17 == 0:
            texts.append(f"{words(20)} {item} {words(20)}")
        else:
            texts.append(words(RNG.randint(20, 200)))
        if i % 2 == 0:
            quality[i] = int(i % 6 != 0)
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in quality.items()], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, sf_dir):
    pytest.importorskip("public_tokenizers")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "minhash near-dedup", "benchmark decontamination", "packing"]
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    item = find(lowered(spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text))
    windows = {tuple(item[i : i + 10]) for i in range(len(item) - 9)}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "stage")
        got = docs.collect()
        if name == "packing":
            assert {r.doc_id for r in got} == set(before)
            break
        assert docs.columns == COLUMNS and all(before[r.doc_id] == r.text for r in got)
        kept = {r.doc_id for r in got}
        if name == "quality classifier":
            junk = {i for i, t in before.items() if "!!" in (t or "")}
            assert len(kept & junk) <= 3 and kept >= set(before) - junk
        elif name == "exact dedup":
            assert kept == {max(i for i, t in before.items() if (t or "") == u) for u in {t or "" for t in before.values()}}
        elif name == "minhash near-dedup":
            root = components({i: shingles(t) for i, t in before.items()})
            assert kept == {i for i in before if root[i] == i} and len(kept) < len(before)
        else:
            hit = {i for i, t in before.items() if any(tuple(w[k : k + 10]) in windows for w in [find(lowered(t))] for k in range(len(w)))}
            assert kept == set(before) - hit and hit
    assert corpus_pipeline.run(spark, sf_dir).count() == len(got)
