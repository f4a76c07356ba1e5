"""Spelling variants, language identification and the conversation trie against plain versions of their contracts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import DATA
from pyspark.sql import functions as F

CLASH = ("word", "Word", "n", "form", "root", "size", "depth", "Lang_Pred", "score", "h", "held", "base")


def clashing(df):
    """Columns whose names clash with results and helpers, also by case."""
    own = {c.lower() for c in df.columns}
    for c in CLASH:
        if c.lower() not in own:
            df, own = df.withColumn(c, F.lit("clash")), own | {c.lower()}
    return df


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(rows, shortest=5, least=3, ratio=2, damage=97):
    c = Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(x.lower() if x.isascii() else x for x in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % damage == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            c[w] += 1
    n = {w: k for w, k in c.items() if k >= least and len(w) >= shortest}
    by = defaultdict(list)
    for w in n:
        by[len(w)].append(w)
    near = {w: [x for size in (len(w) - 1, len(w), len(w) + 1) for x in by[size] if one_edit(w, x)] for w in n}
    form = {w: f for w, own in near.items() if own and n[f := min(own, key=lambda x: (-n[x], x))] >= ratio * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {w: (k, len(near[w]), form.get(w), n[form[w]] if w in form else None, root(w)) for w, k in n.items()}


def variants(df, **kw):
    from spanworks.llm.variants import spelling_variants

    got = spelling_variants(df, **kw).collect()
    out = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got}
    assert len(out) == len(got)
    return out


ODD = [(None, "Éclair éclair éclair éclairs éclairs éclairs"), (-5, None), (1, ""), (1, "  \t"), (2, "ab cd"), (3, "x" * 70_000 + " " + "x" * 70_001), (3, "x" * 70_000), (3, "x" * 70_000)]
ODD += [(4, "abcde abcde abcde abcdf abcdf abcdf abcdg abcdg abcdg"), (4, "abcde abcde abcde abcdf abcdf abcdf abcdg abcdg abcdg"), (5, "façade facade façade façade FAÇADE façades×2 ÷façade naïve_naïve naïve-naive naive NAIVE naive")]
ODD += [(6, " ".join(["chain"] * 3 + ["chaine"] * 6 + ["chaines"] * 12 + ["chaineses"] * 3 + ["chainese"] * 30)), (7, "tail" + "Ātailsātails tails tails"), (8, "aaaaa bbbbb aaaab aabaa " * 3)]


def test_variants_on_odd_rows(spark):
    df = spark.createDataFrame(ODD, "doc_id bigint, text string")
    assert variants(clashing(df)) == plain_variants(ODD)
    as_text = df.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert variants(as_text) == plain_variants(ODD)
    assert variants(df.limit(0)) == {}
    many = plain_variants(ODD, damage=2, least=1, shortest=2)
    assert variants(df, damage=2, least=1, shortest=2) == many and any(r != w for w, (*_, r) in many.items())


def test_variants_at_random(spark):
    draw = random.Random(5)
    rows = [(i, " ".join("".join(draw.choice("aabcé") for _ in range(draw.randint(4, 8))) for _ in range(60))) for i in range(150)]
    want = plain_variants(rows)
    assert sum(x[1] for x in want.values()) > 500
    assert variants(spark.createDataFrame(rows, "doc_id bigint, text string")) == want


def test_variants_on_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert variants(docs) == plain_variants([(r.doc_id, r.text) for r in docs.collect()])


def test_checksums_carry_on():
    import numpy as np

    from spanworks.llm.variants import checksums

    buf = np.frombuffer(b"abcdefghij", np.uint8)
    start, end = np.array([0, 3, 5, 9]), np.array([3, 3, 10, 10])
    heads = np.array([zlib.crc32(x) for x in (b"", b"7:", b"-1:", b"x")], np.uint32)
    assert checksums(buf, start, end, heads).tolist() == [zlib.crc32(x) for x in (b"abc", b"7:", b"-1:fghij", b"xj")]


HELD = "crc32(cast(doc_id as string)) % 4 = 2"


def plain_grams(text, longest=4):
    out = Counter()
    for w in "".join(c.lower() if c.isalpha() else " " for c in text).split():
        w = f" {w} "
        out.update(w[k : k + n] for n in range(1, longest + 1) for k in range(len(w) - n + 1) if w[k : k + n].strip())
    return out


def test_grams_are_those_of_words():
    from spanworks.llm import language

    texts = ["a", "Ab c", "", None, "--", "\0", "é😀ab  ﬁ\n1x", "straße" * 3]
    codes, first = language.letters_of(texts)
    found = [Counter() for _ in texts]
    for n, (_, at) in enumerate(language.grams(codes, 16), 1):
        for a in at:
            k = max(i for i, f in enumerate(first[:-1]) if f <= a)
            found[k]["".join(chr(c) if c else " " for c in codes[a : a + n])] += 1
    assert found == [plain_grams(t or "") for t in texts]


def test_language_held_out(spark):
    from spanworks.llm.language import identify

    docs = clashing(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    got = {r.doc_id: r for r in identify(docs, F.expr(HELD)).collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert got.keys() == lang.keys()
    held = [i for i in got if got[i].held_out]
    assert {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2} == set(held)
    assert sum(got[i].lang_pred == lang[i] for i in held) >= 0.98 * len(held)
    assert all(0 < r.score <= 1 for r in got.values())


LABELLED = [(i, f"{'the cat and the dog ' if i % 2 else 'der hund und die katze '}" * (1 + i % 3), "en" if i % 2 else "de", "s") for i in range(40)]


def test_language_is_naive_bayes(spark, monkeypatch):
    """Without collisions the posteriors are those of a plain multinomial model."""
    from spanworks.llm import language

    rows = LABELLED + [(100, "the", None, "s"), (101, "hund cat", None, "s"), (102, "zzz", None, "s"), (103, "", None, "s"), (104, None, "en", "s"), (105, "12 ?", "en", "s"), (None, "und", None, None), (None, "und", None, None)]
    rows.append((106, "die the " * 30_000, None, "s"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = language.identify(df, F.expr(HELD), bits=20)
    assert [got.schema[c].dataType.simpleString() for c in ("doc_id", "held_out", "lang_pred", "score")] == ["bigint", "boolean", "string", "double"]
    got = got.collect()
    counts, texts = {"de": Counter(), "en": Counter()}, Counter()
    for i, t, x, _ in rows:
        if t is not None and x and zlib.crc32(str(i).encode()) % 4 != 2:
            counts[x] += plain_grams(t)
            texts[x] += any(c.isalpha() for c in t)
    size = {x: sum(c.values()) + 0.5 * 2**20 for x, c in counts.items()}
    assert len(got) == len(rows)
    for r in got:
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        g = plain_grams(text or "")
        if not g:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        total = {x: math.log(texts[x] / sum(texts.values())) + sum(k * math.log((counts[x][w] + 0.5) / size[x]) for w, k in g.items()) for x in counts}
        best = max(sorted(total), key=total.get)
        assert r.lang_pred == best and math.isclose(r.score, 1 / sum(math.exp(v - total[best]) for v in total.values()), rel_tol=1e-6)
    assert not next(r for r in got if r.doc_id is None).held_out
    # a bound on the matrix halves the buckets, a step at a time
    monkeypatch.setattr(language, "MATRIX_BYTES", 2 * 8 << 12)
    few, plain = language.identify(df, F.expr(HELD), bits=14).collect(), language.identify(df, F.expr(HELD), bits=12).collect()
    assert sorted(map(str, few)) == sorted(map(str, plain))


def test_language_uses_the_text_alone(spark):
    from spanworks.llm.language import identify

    df = spark.createDataFrame(LABELLED, "doc_id bigint, text string, lang string, source string")
    held = F.col("doc_id") >= 20
    one = {r.doc_id: (r.lang_pred, r.score) for r in identify(df, held).collect()}
    other = df.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.col("lang"))
    assert one == {r.doc_id: (r.lang_pred, r.score) for r in identify(other, held).collect()}


def test_language_odd_tables(spark, monkeypatch):
    from spanworks.llm import language

    df = spark.createDataFrame(LABELLED, "doc_id bigint, text string, lang string, source string")
    assert language.identify(df.limit(0), F.expr(HELD)).count() == 0
    assert {(r.lang_pred, r.score) for r in language.identify(df, F.lit(True)).collect()} == {("und", 0.0)}
    named = language.identify(df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")), F.lit(False)).collect()
    assert {r.doc_id[0] for r in named} == {"d"} and {r.lang_pred for r in named} == {"de", "en"}
    # more languages than a task holds at once
    monkeypatch.setattr(language, "HELD", 2)
    several = df.withColumn("lang", F.concat("lang", (F.col("doc_id") % 7).cast("string"))).coalesce(1)
    assert language.gram_counts(several, 10).where("bucket = -1").agg(F.sum("n")).first()[0] == len(LABELLED)


def plain_trie(rows, block=20, lent=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda r: hashlib.md5(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()
    said = {c: [r[2:] for r in sorted(x, key=lambda r: (*r[:3], digest(r)))] for c, x in own.items()}
    paths = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % lent
        base = c - int(math.fmod(c, block))
        paths[c] = tuple(said.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    out = set()
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in own if len(paths[c]) == len(node))))
        out.add((min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie(df):
    from spanworks.llm.trie import prefix_trie

    got = [tuple(r) for r in prefix_trie(df).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]
    assert len(set(got)) == len(got)
    return set(got)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def dialogues(draw, n):
    rows = []
    for c in range(-25, n):
        if draw.random() < 0.15:
            continue
        for t in range(draw.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["a b", "a  b", "c", "", "d\te f"])))
    return rows


@pytest.mark.parametrize("piece", [4096, 3])
def test_trie_at_random(spark, monkeypatch, piece):
    from spanworks.llm import trie as module

    monkeypatch.setattr(module, "PIECE", piece)
    rows = dialogues(random.Random(11), 140) + [(c, t, "user", "same") for c in range(200, 260) for t in range(6)]
    assert trie(clashing(spark.createDataFrame(rows, SCHEMA))) == plain_trie(rows)


def test_trie_on_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (3, None, None, None), (3, None, None, None), (3, 1, "user", "x" * 300_000), (4, 1, "b", "t"), (4, 1, "a", "t"), (4, 1, "a", "s"), (5, 0, "", ""), (0, 0, "user", "only"), (21, 0, "u", "r"), (2**62, 0, "user", "far")]
    rows += [(40, t, "user", f"w {t}") for t in range(500)] + [(41, t, "user", f"w {t}") for t in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert trie(df) == plain_trie(rows)
    assert trie(df.withColumn("conv_id", F.when(F.col("conv_id") < 2**31, F.col("conv_id")).cast("int"))) == plain_trie([r for r in rows if r[0] != 2**62])
    assert trie(df.limit(0)) == set()
    with pytest.raises(ValueError, match="whole number"):
        trie(df.withColumn("conv_id", F.col("conv_id").cast("string")))


def test_trie_on_conversations(spark):
    turns = spark.read.parquet(f"{DATA}/conversations.parquet")
    assert trie(turns) == plain_trie([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
