"""The pipeline: what each stage keeps against brute force, what it does with odd rows, and the whole run."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallywick.llm import pii
from test_decontamination import plain as plain_contamination
from test_simhash import plain_components, plain_fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(21)
    path = tmp_path_factory.mktemp("corpus")
    vocabulary = ["w%d" % i for i in range(300)] + "the of and to in is".split()
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, prose(30)) for i in range(6)]
    docs, labels = [], []
    for i in range(240):
        text, good = prose(rng.randrange(60, 200)), i % 4 != 0
        if not good:
            text = text.upper().replace(" ", "!! ")
        elif i % 11 == 1:
            text = docs[-1][1] if good and i % 4 != 1 else text
        elif i % 13 == 2:
            text = prose(20) + " " + items[i % 6][1] + " " + prose(30)
        elif i % 7 == 3:
            text += f" write to some.one{i}@mail.example.com or 10.1.2.3 soon"
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        labels.append((i, int(good)))
    docs += [(None, prose(90), None, None, None), (500, None, "en", "s", 0), (501, prose(90), None, None, None), (501, docs[2][1], None, None, None), (502, prose(3000), "en", "s", None)]
    write = lambda rows, names, kinds, name: pq.write_table(pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names), path / f"{name}.parquet")
    write(docs, COLUMNS, [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()], "documents")
    write(labels, ["doc_id", "quality"], [pa.int64(), pa.int32()], "labels")
    write(items, ["item_id", "text"], [pa.int64(), pa.string()], "benchmark")
    return str(path)


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What went into each stage and what came out."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.cut(stage(spark, docs, folder), name)
        out.append((name, [tuple(r) for r in docs.select(*COLUMNS).collect()], after))
        docs = after
    return {name: (before, after.columns, after.collect()) for name, before, after in out}


def kept(stages, name):
    return sorted((tuple(r) for r in stages[name][2]), key=repr)


def test_stages_call_the_operators_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "byte_bpe"]


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert all(stages[name][1] == COLUMNS for name, _ in corpus_pipeline.STAGES[:-1])


def test_quality_drops_the_bad_and_keeps_the_good(stages):
    left = {r["doc_id"] for r in stages["quality_classifier"][2]}
    assert not {i for i in range(0, 240, 4)} & left
    assert {i for i in range(240) if i % 4} <= left


def test_near_duplicates(stages):
    before = stages["simhash_near_dedup"][0]
    roots = plain_components([r[0] for r in before], [plain_fingerprint(r[1]) for r in before], 4)
    assert kept(stages, "simhash_near_dedup") == sorted({r for r, root in zip(before, roots) if r[0] == root}, key=repr)


def test_contamination(stages, folder):
    before = stages["benchmark_decontamination"][0]
    items = [tuple(r.values()) for r in pq.read_table(f"{folder}/benchmark.parquet").to_pylist()]
    judged = plain_contamination([(r[0], r[1]) for r in before], items)
    bad = {r[0] for r, j in zip(before, judged) if j[-1] and r[0] is not None}
    assert bad and kept(stages, "benchmark_decontamination") == sorted((r for r in before if r[0] not in bad), key=repr)


def test_personal_data_is_gone_and_the_rest_stays(stages):
    before = {r[0]: r for r in stages["pii"][0]}
    masked = 0
    for row in stages["pii"][2]:
        text = before[row["doc_id"]][1]
        found = pii.base_spans(text or "")
        masked += bool(found)
        assert pii.base_spans(row["text"] or "") == []
        if not found:
            assert row["text"] == text
        assert row["n_chars"] is None or row["n_chars"] == len(row["text"])
    assert masked > 5 and len(before) == len(stages["pii"][2])


def test_tokens(stages):
    rows = stages["byte_bpe"][2]
    assert len(rows) == len(stages["byte_bpe"][0]) and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_run_is_the_stages(spark, folder, stages):
    got = sorted((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, folder).where("doc_id is not null").collect())
    assert got == sorted((r["doc_id"], r["ids_sha256"]) for r in stages["byte_bpe"][2] if r["doc_id"] is not None)


CLASHING = ["_score", "score", "_own", "_key", "key", "row", "_kept", "_fp", "fp", "_bad", "_dropped", "ids", "decoded", "_decoded", "component_id", "quality", "label", "a.b"]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_clashing_columns(spark, folder, stages, name):
    """Other columns, whatever their names, neither change a stage's result nor are changed by it."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.createDataFrame(stages[name][0], "doc_id long, text string, lang string, source string, n_chars long")
    more = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in CLASHING})
    got = stage(spark, more, folder)
    if name != "byte_bpe":
        assert got.columns == more.columns
        assert all(r[c] == f"{c} of {'none' if r['doc_id'] is None else r['doc_id']}" for r in got.collect() for c in CLASHING)
        got = got.select(*COLUMNS)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, stages[name][2]), key=repr)


def test_many_ids_to_drop_are_joined(spark):
    rows = spark.createDataFrame([(i if i % 7 else None, str(i)) for i in range(40)], "doc_id long, text string")
    dropped = rows.where("doc_id is null or doc_id % 3 = 0").select("doc_id")
    few, many = (sorted(r["text"] for r in corpus_pipeline.without(rows, "doc_id", dropped, most).collect()) for most in (100, 2))
    assert few == many == sorted(str(i) for i in range(40) if i % 7 and i % 3)


def test_without_n_chars(spark, folder):
    docs = spark.createDataFrame([(1, "mail a.b@c.de"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, dict(corpus_pipeline.STAGES)["pii"](spark, docs, folder).collect())) == [(1, "mail [EMAIL]"), (2, None)]


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, folder), name)
        assert docs.count() == 0
