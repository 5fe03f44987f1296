"""The pipeline stage by stage against plain versions of its decisions."""

import re

import numpy as np
import pytest

import corpus_pipeline
from daybook.llm import quality, simhash
from daybook.llm.common import read_table
from tests.llm.test_decontaminate import brute as hit_words
from tests.llm.test_simhash import roots

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The rows that each stage leaves, by its position; 0 are the documents."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), read_table(spark, SF_DIR, "documents"), []
    out.append({r.doc_id: r for r in docs.collect()})
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        rows = docs.collect()
        out.append({r.doc_id: r for r in rows})
        assert len(out[-1]) == len(rows)
    return out


def test_rejected_documents_go(spark, kept):
    scores = quality.quality_scores(read_table(spark, SF_DIR, "documents"), read_table(spark, SF_DIR, "labels"))
    assert set(kept[1]) == {r.doc_id for r in scores.where("predicted = 1").collect()}
    labels = {r.doc_id: r.quality for r in read_table(spark, SF_DIR, "labels").collect()}
    assert not [i for i in kept[1] if labels.get(i) == 0]
    assert not [i for i, q in labels.items() if q == 1 and i not in kept[1]]


def test_one_of_equal_texts_stays(kept):
    first = {}
    for i, r in sorted(kept[1].items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), i)
    assert set(kept[2]) == set(first.values())


def test_one_of_near_copies_stays(kept):
    ids = sorted(kept[2])
    fps = np.array([simhash.fingerprint((kept[2][i].text or "").encode(), 4) for i in ids], np.uint64)
    found = roots(len(ids), zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)))
    assert set(kept[3]) == {ids[r] for r in found}


def test_contaminated_documents_go(spark, kept):
    items = [(r.item_id, r.text) for r in read_table(spark, SF_DIR, "benchmark").collect()]
    found = hit_words([(i, r.text) for i, r in kept[3].items()], items, 10)
    assert set(kept[4]) == {i for i, _, hit, _ in found if not hit}


def test_last_stage_and_rows(spark, kept):
    assert set(kept[5]) == set(kept[4])
    assert all(r.round_trip for r in kept[5].values())
    for rows in kept[:5]:
        assert next(iter(rows.values())).__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]
    result = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id: r.pieces for r in result.collect()} == {i: r.pieces for i, r in kept[5].items()}


ODD = ("doc_id long, text string, _key int, _sha int, _hit int, _bad int, _row int, id int, sha int, fp int, "
       "_id int, _gone_id int, hash int, _slice int, first int, gone int")


def odd_documents(spark):
    """Null ids and texts, empty and long texts, repeated rows, and every name the stages use."""
    prose = {r.doc_id: r.text for r in read_table(spark, SF_DIR, "documents").limit(40).collect()}
    rows = [(i, t) for i, t in prose.items()] + [(i + 1000, t) for i, t in prose.items()]
    rows += [(None, None), (None, None), (None, "some text"), (2000, None), (2001, ""), (2001, ""), (2002, "  \n"), (2003, "x" * 300_000)]
    rows += [(2004, "word " * 60_000), (2005, prose[0]), (2005, prose[1])]
    return spark.createDataFrame([(i, t, *range(14)) for i, t in rows], ODD)


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents_through_every_stage(spark, stage, empty):
    docs = odd_documents(spark)
    docs = docs.where("false") if empty else docs
    name, function = corpus_pipeline.STAGES[stage]
    found = function(spark, docs, SF_DIR)
    rows = found.collect()
    if stage < len(corpus_pipeline.STAGES) - 1:
        assert found.columns == docs.columns
        assert all(tuple(r)[2:] == tuple(range(14)) for r in rows)
    assert bool(rows) != empty
    ids = [r.doc_id for r in rows]
    if name == "exact dedup" and not empty:
        texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in rows]
        assert len(texts) == len(set(texts)) and min(i for i in ids if i is not None and i >= 2000) == 2000
        assert {2001, 2005, 1001} & set(ids) == set()
    if name == "simhash near-dedup" and not empty:
        assert ids.count(None) == 3 and 2001 not in ids and 1001 not in ids
    if name == "sentencepiece" and not empty:
        assert len(rows) == docs.count()


def test_the_whole_pipeline_on_odd_documents(spark, tmp_path):
    for name in ("labels", "benchmark"):
        read_table(spark, SF_DIR, name).write.parquet(f"{tmp_path}/odd/{name}.parquet")
        read_table(spark, SF_DIR, name).where("false").write.parquet(f"{tmp_path}/empty/{name}.parquet")
    odd_documents(spark).write.parquet(f"{tmp_path}/odd/documents.parquet")
    odd_documents(spark).where("false").write.parquet(f"{tmp_path}/empty/documents.parquet")
    found = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert len(found) > 10 and len({r.doc_id for r in found if r.doc_id is not None}) >= len(found) - 3
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
