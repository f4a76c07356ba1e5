"""Columns whose names clash in another case of letters, and ids that are no bigint."""

import pytest
from pyspark.sql import functions as F

WORDS = " ".join(f"w{i}" for i in range(40))
ROWS = [(3, WORDS), (10, f"x {WORDS}"), (2, f"{WORDS} y"), (7, ""), (8, None), (11, "short one"), (12, "short one"), (None, WORDS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in ROWS], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def as_text(df, column="doc_id"):
    return df.withColumn(column, F.lpad(F.col(column).cast("string"), 4, "0"))


def rows(df, *ids):
    """Rows as a list that has an order, ids as numbers."""
    cols = [F.col(c).cast("bigint").alias(c) if c in ids else F.col(c) for c in df.columns]
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_op3_names(spark, docs):
    from spanworks.llm.rules import judge

    labels = spark.createDataFrame([(3, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = judge(docs.withColumns({"N_Words": F.lit("mine"), "KEPT": F.lit(1)}), labels)
    assert got.columns == [*docs.columns, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert rows(got) == rows(judge(docs, labels))


def test_op9_names(docs):
    from spanworks.llm.debruijn import digests, remove_repeats

    plain = remove_repeats(docs)
    got = remove_repeats(docs.withColumns({"N_Words": F.lit("mine"), "Doc": F.lit("own"), "RAW": F.lit(1)}))
    assert got.columns == [*docs.columns, "Doc", "RAW", "n_words", "n_removed"]
    assert rows(got.drop("Doc", "RAW")) == rows(plain) and digests(got).count() == len(ROWS)
    assert "N_Words" in remove_repeats(docs.withColumn("N_Words", F.lit("mine")), counts=False).columns


@pytest.mark.parametrize("kind", ["int", "string", "decimal(20,0)"])
def test_op9_ids(docs, kind):
    from spanworks.llm.debruijn import digests, remove_repeats, repeated_paths

    other = as_text(docs) if kind == "string" else docs.withColumn("doc_id", F.col("doc_id").cast(kind))
    got = digests(remove_repeats(other))
    assert got.schema["doc_id"].dataType.simpleString() == kind
    assert rows(got, "doc_id") == rows(digests(remove_repeats(docs)), "doc_id")
    assert rows(repeated_paths(other), "doc", "from_doc") == rows(repeated_paths(docs), "doc", "from_doc")


@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_op10_ids(docs, kind):
    from spanworks.llm.minhash import near_duplicates

    own = {"int": lambda c: F.col(c).cast("int"), "date": lambda c: F.date_add(F.lit("2000-01-01").cast("date"), F.col(c).cast("int"))}
    other = as_text(docs) if kind == "string" else docs.withColumn("doc_id", own[kind]("doc_id"))
    got = near_duplicates(other)
    assert got.schema["doc_id"].dataType.simpleString() == got.schema["component_id"].dataType.simpleString() == kind
    if kind == "date":
        got = got.withColumns({c: F.datediff(c, F.lit("2000-01-01")) for c in ("doc_id", "component_id")})
    assert rows(got, "doc_id", "component_id") == rows(near_duplicates(docs), "doc_id", "component_id")
    assert near_duplicates(other.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["int", "string"])
def test_op4_ids(docs, kind):
    from spanworks.llm.tiff import media_rows

    got = media_rows(docs.withColumn("doc_id", F.col("doc_id").cast(kind)))
    assert got.schema["doc_id"].dataType.simpleString() == kind
    assert rows(got, "doc_id") == rows(media_rows(docs), "doc_id")


def test_op7_ids(spark):
    from spanworks.llm.warc import archive_pages

    pages = spark.createDataFrame([(5, "u", WORDS), (-3, None, WORDS), (6, "u", "small"), (7, "u", None), (None, "u", WORDS)], "page_id bigint, url string, html string")
    whole = rows(archive_pages(pages))
    assert (5, len(WORDS), whole[0][2], "revisit", -3) in whole or any(r[0] == 5 and r[4] == -3 for r in whole)
    small = archive_pages(pages.withColumn("page_id", F.col("page_id").cast("int")))
    assert small.schema["refers_to"].dataType.simpleString() == "int" and rows(small, "page_id", "refers_to") == whole
    odd = ["", "''", "a b/%<>\r\n", "é", "z"]
    named = spark.createDataFrame([(i, "u", WORDS if k % 2 else f"only {k}") for k, i in enumerate(odd)] + [(None, "u", WORDS)], "page_id string, url string, html string")
    got = {r.page_id: r for r in archive_pages(named).collect()}
    assert set(got) == {*odd, None} and {i: (r.record_type, r.refers_to) for i, r in got.items() if i} == {"''": ("response", None), "a b/%<>\r\n": ("response", None), "é": ("revisit", "''"), "z": ("response", None)}


@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_op8_ids(docs, kind):
    from spanworks.llm.sharding import shard

    own = {"int": lambda c: F.col(c).cast("int"), "string": lambda c: F.lpad(F.col(c).cast("string"), 4, "0"), "date": lambda c: F.date_add(F.lit("2000-01-01").cast("date"), F.col(c).cast("int"))}
    other = docs.withColumn("doc_id", own[kind]("doc_id")).withColumns({"Shard": F.lit("mine"), "SLOT": F.lit(1)})
    got = shard(other, 3)
    assert got.columns == shard(docs, 3).columns and got.schema["doc_id"].dataType.simpleString() == kind
    found = got.collect()
    assert len(found) == len(ROWS) and all(0 <= r.shard < 3 and r.grown_shard in (r.shard, 3) for r in found)
    for k in range(3):
        inside = sorted((r for r in found if r.shard == k), key=lambda r: r.slot)
        assert [r.slot for r in inside] == list(range(len(inside)))
        ids = [r.doc_id for r in inside if r.doc_id is not None]
        assert ids == sorted(ids)
    if kind == "int":
        assert rows(got, "doc_id") == rows(shard(docs, 3))
    # an id alone decides: the same ids in another table are in the same shards
    few = {r.doc_id: (r.shard, r.grown_shard) for r in shard(other.where("text is not null"), 3).collect()}
    assert few == {r.doc_id: (r.shard, r.grown_shard) for r in found if r.doc_id in few}
    assert shard(other.limit(0), 3).count() == 0


@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_op5_ids(docs, kind):
    from spanworks.llm.mixing import blocks, mixed_documents

    own = {"int": lambda c: F.col(c).cast("int"), "string": lambda c: F.lpad(F.col(c).cast("string"), 4, "0"), "date": lambda c: F.date_add(F.lit("2000-01-01").cast("date"), F.col(c).cast("int"))}
    sources = docs.withColumn("source", F.when(F.col("doc_id") > 2, F.when(F.col("doc_id") > 7, "big").otherwise("small")))
    other = sources.withColumn("doc_id", own[kind]("doc_id")).withColumns({"Row": F.lit("mine"), "BLOCK": F.lit(1), "Key": F.lit(2)})
    got, plain = blocks(other), blocks(sources)
    assert got.columns == plain.columns and got.schema["doc_id"].dataType.simpleString() == kind
    weights = lambda df: {r.source: r.weight for r in df.select("source", "weight").distinct().collect()}
    assert weights(got) == pytest.approx(weights(plain))
    read = got.collect()
    assert len({r.doc_id for r in read}) == len(ROWS) and len([r for r in read if r.epoch == 0]) == len(ROWS)
    for b in {r.block for r in read}:
        assert sorted(r.slot for r in read if r.block == b) == list(range(sum(r.block == b for r in read)))
    written = mixed_documents(other)
    assert written.columns == other.columns
    count = lambda found: {i: sum(r.doc_id == i for r in found) for i in {r.doc_id for r in found}}
    assert count(written.collect()) == count(read)
