"""Registered queries on the smallest tables, against their SQL or a plain form of the same rules."""

import re
import zlib
from collections import Counter

import pytest

from crewcast.llm.queries import ORACLES, QUERIES
from tests.llm.test_operators import plain_components
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) == "ok"


def test_every_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_toxicity_separates_held_out_documents(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = QUERIES["op1_toxicity"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert right / len(held) > 0.88


def test_language_of_held_out_documents(spark):
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and sum(known[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.97


def test_quality_orders_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in QUERIES["op6_quality_classifier"](spark, "/root/testdata/sf0.01").collect() if r["held_out"] and r["doc_id"] in labels]
    good, bad = ([r["expected_grade"] for r in rows if labels[r["doc_id"]] == k] for k in (1, 0))
    wins = sum(g > b for g in good for b in bad) / (len(good) * len(bad))
    assert wins > 0.9 and all(0 <= r["tails"][0] <= 1 for r in rows)


def test_packed_pieces_are_the_tokenizers_ids(spark, documents):
    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = QUERIES["op3_best_fit_packing"](spark, FOLDER).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(documents)
    for key, pieces in by_doc.items():
        ids = np.array(tokenizer.encode(documents[key]["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces))) and sum(r["length"] for r in pieces) == len(ids)
        assert all(r["length"] == 1024 for r in pieces[1:]) and (len(pieces) == 1) == (len(ids) <= 1024)
        at = 0
        for r in pieces:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_held_out_labels_do_not_reach_a_score(spark, tmp_path):
    import shutil

    for name in ("documents", "labels"):
        shutil.copy(f"{FOLDER}/{name}.parquet", tmp_path)
    held = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas()
    fold = [zlib.crc32(str(i).encode()) % 4 == 2 for i in held["doc_id"]]
    held.loc[fold, "toxic"] = 1 - held.loc[fold, "toxic"]
    held.to_parquet(f"{tmp_path}/labels.parquet")
    before, after = ({r["doc_id"]: r["score"] for r in QUERIES["op1_toxicity"](spark, f).collect()} for f in (FOLDER, str(tmp_path)))
    assert before == after


def plain_leaks(texts: dict, items: dict, percent: int = 80) -> dict:
    """(document, item) -> similarity of the most similar window, over all windows."""
    def runs(text):
        words = re.findall(r"[^\W_]+", (text or "").lower())
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
    found = {}
    items = {k: Counter(runs(t)) for k, t in items.items()}
    for key, text in texts.items():
        held = runs(text)
        for item, want in items.items():
            size = sum(want.values())
            if not size or not want.keys() & set(held):
                continue  # no window has a shingle in common
            for i in range(max(1, len(held) - size + 1)):
                part = Counter(held[i : i + size])
                common = sum((part & want).values())
                similar = common / (sum(part.values()) + size - common)
                if 100 * similar >= percent:
                    found[key, item] = max(similar, found.get((key, item), 0))
    return found


def test_near_duplicates_equal_all_pairs(spark, documents):
    found = {r["doc_id"]: r["component_id"] for r in QUERIES["op5_near_dedup"](spark, FOLDER).collect()}
    assert found == plain_components([(k, r["text"]) for k, r in documents.items()], 2, 80)


def test_benchmark_passages_equal_all_windows(spark, documents):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    found = {(r["doc_id"], r["item_id"]): r["similarity"] for r in QUERIES["op10_benchmark_decontamination"](spark, FOLDER).collect()}
    assert found == pytest.approx(plain_leaks({k: r["text"] for k, r in documents.items()}, items))


def planted(spark, documents) -> tuple:
    """The documents with planted exact copies, near copies and benchmark passages."""
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    long = [r for r in documents.values() if r["text"] and 100 < len(r["text"].split()) < 400][:8]
    more = []
    for n, r in enumerate(long[:4]):
        more.append((90_000 + n, r["text"]))
        words = r["text"].split()
        words[len(words) // 2] = "changed"
        more.append((91_000 + n, " ".join(words)))
    more += [(92_000 + n, f"{' '.join(r['text'].split()[:60])} {items[n]}") for n, r in enumerate(long[4:])]
    rows = [tuple(r) for r in documents.values()] + [(k, t, "en", "planted", len(t)) for k, t in more]
    return rows, items, {k for k, _ in more}


def test_every_stage_of_the_pipeline_equals_a_plain_form(spark, documents):
    import corpus_pipeline as pipeline
    from crewcast.llm.queries import toxicity_model

    rows, items, extra = planted(spark, documents)
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    columns, left, gone = docs.columns, {r[0]: r[1] for r in rows}, {}
    model = toxicity_model(spark, FOLDER)
    scores = dict(zip(left, model.score(list(left.values()))))

    def smallest(texts):
        return {t: min(k for k in texts if texts[k] == t) for t in texts.values()}

    plain = {
        "toxicity": lambda texts: {k for k in texts if scores[k] < model.settings.threshold},
        "exact_dedup": lambda texts: set(smallest({k: t or "" for k, t in texts.items()}).values()),
        "near_dedup": lambda texts: {k for k, c in plain_components(list(texts.items()), 5, 80).items() if k == c},
        "benchmark_decontamination": lambda texts: set(texts) - {k for k, _ in plain_leaks(texts, items)},
    }
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == columns, name
        docs = spark.createDataFrame(after.collect(), after.schema)
        kept = [r["doc_id"] for r in docs.collect()]
        assert sorted(kept) == sorted(plain[name](left)), name
        gone[name] = set(left) - set(kept)
        left = {k: left[k] for k in kept}
    assert gone["exact_dedup"] >= {k for k in extra if 90_000 <= k < 91_000} - gone["toxicity"]
    assert gone["near_dedup"] >= {k for k in extra if 91_000 <= k < 92_000} - gone["toxicity"]
    assert gone["benchmark_decontamination"] >= {k for k in extra if k >= 92_000} - gone["toxicity"]
    packed = pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r["doc_id"] for r in packed} == set(left)


def test_pipeline_is_its_stages_in_order(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in pipeline.STAGES:
        after = stage(spark, docs, FOLDER)
        docs = spark.createDataFrame(after.collect(), after.schema)
    key = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert sorted(map(key, pipeline.run(spark, FOLDER).collect())) == sorted(map(key, docs.collect()))
