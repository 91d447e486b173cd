"""The pipeline stage by stage against plain Python and SQL on its own input."""

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tabulare.llm import mixing, oracles
from tabulare.session import work_table
from test_near import find, full_set

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def linked_roots(rows, percent):
    """Component by key, of pairs that share a run of words."""
    sets = {key: full_set(text) for key, text in rows}
    roots, at = {key: key for key in sets}, {}
    for key, s in sets.items():
        for shingle in s:
            at.setdefault(shingle, []).append(key)
    for a, b in {(a, b) for found in at.values() for a in found for b in found if a < b}:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            low, high = sorted((find(roots, a), find(roots, b)))
            roots[high] = low
    return {key: find(roots, key) for key in sets}


def test_every_stage(spark, folder, duck):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r.doc_id: tuple(r) for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "encode"]

    def after(name, frame):
        found = work_table(stages[name](spark, frame, folder), name)
        return found, found.collect()

    docs, rows = after("quality_rules", docs)
    kept = duck.execute(f"SELECT doc_id FROM ({oracles.LLM_ORACLES['op9_quality_rules']}) WHERE kept").fetchall()
    assert docs.columns == COLUMNS and {tuple(r) for r in rows} == {before[k] for (k,) in kept} and len(rows) == len(kept)

    docs, rows_after = after("exact_dedup", docs)
    largest = {}
    for r in rows:
        largest[r.text] = max(r.doc_id, largest.get(r.text, r.doc_id))
    assert docs.columns == COLUMNS and {tuple(r) for r in rows_after} == {before[k] for k in largest.values()}
    assert len(largest) == len(rows_after) < len(rows)

    docs, rows = after("near_dedup", docs)
    roots = linked_roots([(r.doc_id, r.text) for r in rows_after], corpus_pipeline.NEAR_PERCENT)
    assert docs.columns == COLUMNS and {tuple(r) for r in rows} == {before[k] for k in roots.values()}
    assert len(rows) == len(set(roots.values())) < len(rows_after)

    docs, mixed = after("mix_sources", docs)
    duck.register("remaining", docs.select("doc_id", "source").toPandas())
    order = duck.execute(
        f"WITH RECURSIVE docs AS (SELECT * FROM remaining), {oracles.MIXING_TABLES} SELECT doc_id FROM mixed ORDER BY position"
    ).fetchall()
    written = [r.doc_id for r in mixing.written_order(docs).orderBy("_position").select("_row.doc_id").collect()]
    assert docs.columns == COLUMNS and written == [k for (k,) in order]
    assert sorted(map(tuple, mixed)) == sorted(map(tuple, rows))

    docs, rows = after("encode", docs)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.position)] == written
    assert sorted(r.position for r in rows) == list(range(len(rows)))
    for r in rows:
        ids = tokenizer.encode(before[r.doc_id][1], add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).drop("ids").collect())) == sorted(
        (r.doc_id, r.n_tokens, r.decoded_sha256) for r in rows
    )


def test_odd_rows_and_empty_tables(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(1, text, "x", "s"), (1, text, "x", "s"), (2, None, None, None), (3, "", "x", None), (None, text + " end", "y", "t"),
            (5, " ".join(f"v{i}" for i in range(30_000)), None, None)]
    schema = "doc_id bigint, text string, lang string, source string"
    labels = "doc_id bigint, quality int, toxic int"
    for name, found in (("some", rows), ("none", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(found, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(1, 1, None), (None, None, 0)] if found else [], labels).write.parquet(f"{folder}/labels.parquet")
        ids = sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, folder).collect())
        assert ids == (["5", "None"] if found else [])


def test_the_mixture_survives_several_files(spark, folder, duck):
    """The last table is written to many files, which are not read back in their order: positions and run() keep it."""
    options = {
        "spark.sql.shuffle.partitions": "7",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "200k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {name: spark.conf.get(name) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        encoded = corpus_pipeline.encoded_mixture(spark, folder)
        assert len(encoded.inputFiles()) > 3
        rows = encoded.collect()
        returned = [r.doc_id for r in corpus_pipeline.run(spark, folder).collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    duck.register("encoded", encoded.select("doc_id", "source").toPandas())
    order = duck.execute(
        f"WITH RECURSIVE docs AS (SELECT * FROM encoded), {oracles.MIXING_TABLES} "
        "SELECT doc_id, source, row_number() OVER (ORDER BY position) - 1 FROM mixed ORDER BY position"
    ).fetchall()
    assert {(r.doc_id, r.source, r.position) for r in rows} == set(order) and len(rows) == len(order)
    assert returned == [key for key, *_ in order]
    assert [r.doc_id for r in rows] != returned  # read back in another order: the column is needed
