"""Each operator against a plain version of its contract, on the smallest tables and on odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from conftest import DATA
from pyspark.sql import functions as F

ODD = [(None, "a b a b a b"), (7001, None), (7002, ""), (7003, " \n\t "), (7004, "one"), (7004, "one"), (7005, "w " * 60), (7006, "x y z " * 40), (7007, "é　ﬁ ▁ \x0b😀 " * 30), (7008, "q" * 5000), (7009, " ".join(f"w{i}" for i in range(30))), (7010, "z " + " ".join(f"w{i}" for i in range(30))), (7011, "\n".join(["same line here"] * 5))]


def words(t, lower=False):
    raw = (t or "").encode()
    return re.findall(rb"[^\x20\x09-\x0D]+", raw.lower() if lower else raw)


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame([(i, t, "xx" if k % 2 else None, None if k % 3 else "src0", None) for k, (i, t) in enumerate(ODD)], base.schema)
    # columns whose names clash with results and helpers
    clash = ("n_words", "kept", "tokens", "seed", "set", "page", "key", "spans", "shard", "error")
    return base.union(odd).withColumns({c: F.lit("clash") for c in clash}).cache()


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def by_id(rows):
    """Rows by id; equal ids hold equal texts here."""
    return {r.doc_id: r for r in rows}


def quantised(n):
    """What a count of n is read back as."""
    level = n.bit_length() if n else 0
    return [0, 1, 2.3][level] if level < 3 else 2 ** (level - 1) * 1.3


def plain_scores(toks, out):
    """The model of op1 over plain counts: no filter, hashes or segments."""
    c, pairs = Counter(), Counter()
    for i, w in toks:
        if not out(i):
            c.update(w)
            pairs.update(zip(["begin", *w], w))
    mass = sum(quantised(n) + 1 for n in c.values()) + 1
    level = lambda h: (c[None] if h == "begin" else c[h]).bit_length()
    once, twice, kinds, total = Counter(), Counter(), Counter(), Counter()
    for (h, _), m in pairs.items():
        g = level(h)
        once[g] += m == 1
        twice[g] += m == 2
        kinds[g] += 1
        total[g] += m
    discount = lambda g: min(max(once[g] / max(once[g] + 2 * twice[g], 1), 0.1), 0.95)
    weight = lambda g: (once[g] + discount(g) * (kinds[g] - once[g])) / total[g] if total[g] else 1.0

    def one(h, w):
        g, word = level(h), (quantised(c[w]) + 1) / mass
        if not g:
            return word
        ctx, m = quantised(c[None] if h == "begin" else c[h]), pairs[h, w]
        return min(1.0, max(min(quantised(m) if m > 1 else 0, ctx) - discount(g), 0) / ctx + weight(g) * word)

    return {i: sum(math.log10(one(h, w)) for h, w in zip(["begin", *t], t)) for i, t in toks}


@pytest.mark.parametrize("share, shard", [(1e-6, 64_000_000), (2e-4, 600_000), (1e-2, 64_000_000), (1e-2, 200_000)])
def test_op1(docs, plain, monkeypatch, share, shard):
    from spanworks.llm import scoring

    monkeypatch.setattr(scoring, "SHARD_BYTES", shard)
    monkeypatch.setattr(scoring, "SHARD_SHARE", 0.0)
    monkeypatch.setattr(scoring, "FREQUENT", share)
    monkeypatch.setattr(scoring, "BITS_PER_ENTRY", 1024)  # so that the filter hardly errs
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    got = scoring.score_texts(docs, held).collect()
    out = lambda i: True if i is None else zlib.crc32(str(i).encode()) % 7 == 2
    toks = [(i, [*words(t, True), None]) for i, t in plain]
    c = Counter(x for i, w in toks if not out(i) for x in w)
    n, v = sum(c.values()), len(c)
    want = plain_scores(toks, out)
    assert len(got) == len(plain)
    for r in got:
        w = next(x for i, x in toks if i == r.doc_id)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert math.isclose(r.score, want[r.doc_id], rel_tol=1e-3)
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen), "better than the base on unseen texts"
    assert all(r.score <= 0 for r in got)


def plain_whole_scores(toks, out):
    """The model of op1's query over plain counts: bigrams seen once count like all others."""
    c, pairs, after = Counter(), Counter(), defaultdict(Counter)
    for i, w in toks:
        if not out(i):
            c.update(w)
            pairs.update(zip(["begin", *w], w))
    seen = lambda h: c[None] if h == "begin" else c[h]
    for (h, _), m in pairs.items():
        after[seen(h).bit_length()][m] += 1
    mass = sum(quantised(n) + 1 for n in c.values()) + 1

    def one(h, w):
        word, of = (quantised(c[w]) + 1) / mass, after[seen(h).bit_length()]
        if not seen(h):
            return word
        discount = min(max(of[1] / max(of[1] + 2 * of[2], 1), 0.1), 0.95)
        back = discount * sum(of.values()) / sum(m * k for m, k in of.items())
        return min(1.0, max(quantised(pairs[h, w]) - discount, 0) / quantised(seen(h)) + back * word)

    return {i: sum(math.log10(one(h, w)) for h, w in zip(["begin", *t], t)) for i, t in toks}


@pytest.mark.parametrize("shard, cut", [(64_000_000, [False, False]), (6_000_000, [False, True]), (200_000, [True, True])])
def test_op1_holds_every_bigram(spark, docs, monkeypatch, tmp_path, shard, cut):
    from spanworks.llm import queries, scoring

    shards, plan = [], scoring.cut_shards
    monkeypatch.setattr(scoring, "cut_shards", lambda *a: shards.append(plan(*a)) or shards[-1])
    monkeypatch.setattr(scoring, "SHARD_BYTES", shard)
    monkeypatch.setattr(scoring, "SHARD_SHARE", 0.0)
    monkeypatch.setattr(scoring, "BITS_PER_ENTRY", 1024)  # so that the filter hardly errs
    out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    trained = next(i for i in range(9000, 9100) if not out(i))
    same, turned = [i for i in range(9100, 9200) if out(i)][:2]
    unique = [f"once{k}" for k in range(40)]
    rows = [(r.doc_id, r.text) for r in docs.where("doc_id is not null").select("doc_id", "text").collect()]
    rows += [(trained, " ".join(unique)), (same, " ".join(unique)), (turned, " ".join(unique[::-1]))]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.score for r in queries.op1_bloom_lm(spark, str(tmp_path)).collect()}
    want = plain_whole_scores([(i, [*words(t, True), None]) for i, t in rows], out)
    assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-3) for i in want)
    assert [len(x) > 1 for x in shards] == cut, "the words' filter, then the bigrams', in one shard or more"
    assert got[same] == pytest.approx(got[trained])
    assert got[same] > got[turned] / 2, "bigrams seen once tell a text from its words the other way round"


def test_op1_without_training(spark, docs):
    from spanworks.llm.scoring import score_texts

    assert all(r.n_known == 0 and r.train_tokens == 0 for r in score_texts(docs.limit(5), F.lit(True)).collect())
    assert score_texts(docs.limit(0), F.lit(False)).count() == 0


TURNS = [(None, None, None, None), (None, 1, "assistant", "x<\\|y<\\\\|z\n<|"), (7000, 0, "system", ""), (7000, 1, "sy%0A\nx<|im_end|>", "a\n\n"), (7000, 2, "assistant", "😀" * 9000), (7000, 3, "assistant", ""), (7000, 3, "assistant", "")]
TURNS += [(7001, i, ["system", "user", "assistant"][min(i, 1 + i % 2)], f"text {i} " * (i % 9)) for i in range(900)]


def test_op2(spark):
    from spanworks.llm import chat

    base = spark.read.parquet(f"{DATA}/conversations.parquet")
    rows = base.union(spark.createDataFrame(TURNS, base.schema)).withColumn("window", F.lit("clash"))
    made = chat.windows(rows, target=400, history=100)
    got = {r.conv_id: r for r in chat.conversation_digests(made).collect()}
    conv = defaultdict(list)
    for r in rows.collect():
        conv[r.conv_id].append((-1 if r.turn is None else r.turn, r.role or "", r.text or ""))
    assert set(got) == set(conv)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for c, turns in conv.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for _, a, b in turns)), len(said), sha(said))
    for w in made.where("conv_id = 7001").collect():
        assert w.n_tokens <= 400 + 100 + 6 and w.text.startswith("<|im_start|>system\n")
        assert w.window == 0 or w.n_context > 1, "history is repeated"
    assert chat.windows(rows.limit(0)).count() == 0


def plain_windows(turns, target, history):
    """{window: [(number, repeated)]} of one conversation's (role, text), by walking its turns."""
    tokens = [-(-(len(r.encode()) + len(x.encode())) // 4) + 6 for r, x in turns]
    to, at = list(itertools.accumulate(tokens)), [0, *itertools.accumulate(tokens)][: len(tokens)]
    system = [r == "system" for r, _ in turns]
    room = max(target - max((n for n, s in zip(tokens, system) if s), default=0), target - target // 2)
    lead = bool(system and system[0])
    skip = to[0] if lead else 0
    cell = lambda x: (x - skip) // room
    new = defaultdict(list)
    for k in range(lead, len(turns)):
        new[2 * cell(at[k]) + (cell(at[k]) != cell(to[k] - 1))].append(k)
    out = {}
    for w, own in new.items():
        first = own[0]
        holds = None if system[first] else max((k for k in range(first) if system[k]), default=None)
        known = {k for k in range(lead, first) if tokens[k] <= history and at[k] >= at[first] - history}
        known |= {holds} - {None}
        out[w] = sorted([*((k, True) for k in known), *((k, False) for k in own)])
    if lead:
        out[0] = [(0, False), *(x for x in out.get(0, []) if x[0])]
    return out


def check_windows(made, rows, target, history):
    """All windows against the plain version: turns, text, loss and tokens."""
    conv = defaultdict(list)
    for c, t, r, x in rows:
        conv[c].append((t, r, x))
    want = {}
    for c, turns in conv.items():
        said = [x[1:] for x in sorted(turns, key=lambda x: x[0])]
        for w, parts in plain_windows(said, target, history).items():
            text, loss = "", []
            for k, again in parts:
                role, body = said[k]
                text += f"<|im_start|>{role}\n"
                if role == "assistant" and not again:
                    loss.append((len(text), len(text) + len(body)))
                text += f"{body}<|im_end|>\n"
            want[c, w] = (text, loss, sum(a for _, a in parts), sum(-(-(len(said[k][0].encode()) + len(said[k][1].encode())) // 4) + 6 for k, _ in parts))
    got = {(r.conv_id, r.window): (r.text, [tuple(x) for x in r.loss], r.n_context, r.n_tokens) for r in made}
    assert got.keys() == want.keys()
    assert got == want


SPOKEN = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("chars, at", [(40_000, 0), (4_000, 0), (2_000, 0), (2_000, 1), (5_000, 1), (100, 17)])
def test_op2_keeps_the_system_turn(spark, chars, at):
    from spanworks.llm import chat

    rows = [(1, k, "system" if k == at else "user" if k % 2 else "assistant", "s" * chars if k == at else f"{k} " + "x" * 900) for k in range(30)]
    made = chat.windows(spark.createDataFrame(rows, SPOKEN)).collect()
    check_windows(made, rows, chat.TARGET, chat.HISTORY)
    n = -(-(chars + 6) // 4) + 6
    room = max(chat.TARGET - n, chat.TARGET // 2)
    behind = [w for w in made if f"{at + 1} xx" in w.text or w.window > min(x.window for x in made if "s" * chars in x.text)]
    assert behind and all(w.text.count("s" * chars) == 1 for w in behind)
    assert all(w.n_tokens <= n + room + chat.HISTORY for w in made)


def test_op2_windows_at_random(spark):
    from spanworks.llm import chat

    draw, rows = random.Random(7), []
    for c in range(60):
        for k in range(draw.randint(1, 25)):
            rows.append((c, k, draw.choice(["system", "user", "assistant", "assistant"]), f"{k} " + "w" * draw.choice([0, 3, 20, 90, 300, 700])))
    df = spark.createDataFrame(rows, SPOKEN)
    for target, history in ((120, 40), (64, 64), (100, 0)):
        check_windows(chat.windows(df, target, history).collect(), rows, target, history)


def test_op3_statistics(spark, docs, plain):
    from spanworks.llm.rules import judge_narrow

    got = by_id(judge_narrow(docs, spark.read.parquet(f"{DATA}/labels.parquet")).collect())
    for i, t in plain:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        c = Counter(tri)
        covered = {k + d for k, x in enumerate(tri) if c[x] > 1 for d in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.base_failed and r.kept)
    assert judge_narrow(docs.limit(0), spark.read.parquet(f"{DATA}/labels.parquet")).count() == 0


def plain_cutoffs(held, risk=0.02, error=0.05):
    """{(stratum, rule): cutoff} of the rows (stratum, {rule: score}), by exact tails in fractions."""
    from spanworks.llm.rules import RULES

    def tail(n, k, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))

    by = defaultdict(list)
    for s, scores in held:
        for rule, x in scores.items():
            by[s, rule].append(x)
    out = {}
    for key, xs in by.items():
        for cut in RULES[key[1]][1]:
            k = sum(x >= cut for x in xs)
            if k > len(xs) * risk / len(RULES) or tail(len(xs), k, risk / len(RULES)) > error / len(by):
                break
            out[key] = cut
    return out


@pytest.mark.parametrize("risk", [0.02, 0.4])
def test_op3_kept(spark, docs, plain, risk):
    from spanworks.llm.rules import RULES, judge, judge_narrow, kept_documents

    labels = spark.createDataFrame([(r.doc_id, r.lang, r.text) for r in docs.collect()], "doc_id long, lang string, text string").select("doc_id", F.lit(1).alias("quality"), F.when(F.col("doc_id") % 9 == 0, 1).when(F.col("doc_id") % 9 == 1, None).otherwise(0).alias("toxic"))
    rows = docs.select("doc_id", "lang", "text", *[F.lit("own").alias(c) for c in ("n_words", "_w", "symbols_per_word", "stratum", "id", "_id", "doc")])
    got = judge_narrow(rows, labels, risk=risk).collect()
    names = {"symbols_per_word": ("n_symbols", "n_words"), "long_words": ("word_chars", "n_words"), "repeat_words": ("n_repeat_words", "n_words"), "dup_lines": ("n_dup_lines", "n_words")}
    scores = lambda r: {k: r[a] / r[b] if r[b] else 0.0 for k, (a, b) in names.items()}
    text = dict(plain)
    held = {(r.lang, text[r.doc_id]): (r.lang, scores(r)) for r in got if not r.base_failed and r.doc_id is not None and r.doc_id % 9 != 0}
    cuts = plain_cutoffs(held.values(), risk)
    assert bool(cuts) == (risk > 0.1)
    for r in got:
        assert r.kept == (not r.base_failed and not any(x >= cuts.get((r.lang, k), math.inf) for k, x in scores(r).items()))
    same = lambda rows: sorted((str(r.doc_id), r.kept) for r in rows)
    assert same(judge(rows, labels, risk=risk).collect()) == same(got)
    kept = kept_documents(rows, labels, risk=risk)
    assert kept.columns == rows.columns and all(r.n_words == "own" for r in kept.collect())
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert set(RULES) == set(names)


def test_op5_equal_rows_keep_the_limit(spark):
    from spanworks.llm import mixing

    rows = [(1, "a b c d e", "x", "own")] * 400 + [(k, "a b c d e f g h i j" * 20, "y", "own") for k in range(2, 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _source string").withColumns({"_full": F.lit(1), "row": F.lit(2), "block": F.lit(3)})
    read = mixing.blocks(docs, max_repeat=1.5).collect()
    mixed = mixing.mixed_documents(docs, max_repeat=1.5).collect()
    assert Counter((r.doc_id, r.source) for r in read) == Counter((r.doc_id, r.source) for r in mixed)
    assert sum(r.source == "x" for r in mixed) <= 601 and {r.row for r in mixed} == {2}


def test_op3_binomial(spark):
    from spanworks.llm.rules import binomial_tail

    rows = [(n, k) for n in (1, 10, 400, 5000, 200_000) for k in (0, 1, 3, 20) if k <= n]
    df = spark.createDataFrame(rows, "n bigint, k bigint")
    for r in df.select("n", "k", binomial_tail(F.col("n"), F.col("k"), 0.01).alias("p")).collect():
        logs = [math.lgamma(r.n + 1) - math.lgamma(i + 1) - math.lgamma(r.n - i + 1) + i * math.log(0.01) + (r.n - i) * math.log(0.99) for i in range(r.k + 1)]
        want = sum(map(math.exp, logs)) if r.k <= r.n * 0.01 else 1.0
        assert r.p == pytest.approx(want, rel=1e-6, abs=1e-300)


def test_op3_cutoffs_keep_the_risk(spark):
    from spanworks.llm import rules

    # good documents have symbol ratios below 0.3, one in a hundred above; bad ones lie above 1
    rows = [(i, "s", False, 0.35 if i % 100 == 0 else (i % 29) / 100, 5.0, 0.0, 0.0) for i in range(6000)] + [(i, "s", False, 1.5, 5.0, 0.0, 0.0) for i in range(9000, 9500)] + [(99_999, "few", False, 0.0, 5.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, base_failed boolean, symbols_per_word double, long_words double, repeat_words double, dup_lines double")
    labels = df.select("doc_id", (F.col("doc_id") < 9000).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    good = df.join(rules.good_ids(labels), F.col("doc_id") == F.col("_id"), "left_semi")
    got = {(r.stratum, r.rule): r.cutoff for r in rules.cutoffs(good, "lang").collect()}
    # copies of one text don't make a cutoff surer
    few = good.where("doc_id < 300")
    many = few.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20)))).withColumn("key", F.col("doc_id"))
    assert sorted(map(tuple, rules.cutoffs(many, "lang", text_key="key").collect())) == sorted(map(tuple, rules.cutoffs(few, "lang").collect()))
    assert got["s", "symbols_per_word"] == 0.4 and not any(s == "few" for s, _ in got)


def test_op4(docs, plain):
    from spanworks.llm.tiff import media_rows

    got = by_id(media_rows(docs).collect())
    for i, t in plain:
        raw = (t or "").encode()
        pay = raw + b" " * (-len(raw) % 192 if raw else 192)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-16:]))


def test_op4_pages(spark):
    import os

    from spanworks.llm import tiff

    random = os.urandom(192 * 700)
    big = b"ab  " * (192 * 900 // 4)
    images = [(1, tiff.write_tiff(random)), (2, tiff.write_tiff(big)), (3, None), (4, b""), (5, b"II*\0\xff\xff\xff\x00"), (6, tiff.write_tiff(big)[:5000]), (7, b"II*\0\x08\0\0\0\0\0\x08\0\0\0")]
    rows = tiff.read_pages(spark.createDataFrame(images, "id long, media binary").withColumn("page", F.lit("clash"))).collect()
    assert b"".join(bytes(r.samples) for r in rows if r.id == 1) == random and b"".join(bytes(r.samples) for r in rows if r.id == 2) == big
    assert all(len([r for r in rows if r.id == k]) == 1 and next(r.error for r in rows if r.id == k) for k in (3, 4, 5, 6, 7))
    for d in (b"", b"a", b"aaaa" * 9000, random, big, bytes(range(256)) * 40):
        assert tiff.lzw_decode(tiff.lzw_encode(d)) == d and tiff.packbits_decode(tiff.packbits_encode(d)) == d


def tiff(width, height, data, order="<", bits=8, spp=1, planar=1, predictor=1, kind=1, rows=None, **more):
    """A one-page file of uncompressed strips; ``data`` is a list of strips."""
    import struct

    fields = {256: [width], 257: [height], 258: [bits] * spp, 259: [1], 273: [], 277: [spp], 278: [rows or height], 279: [len(d) for d in data], 284: [planar], 317: [predictor], 339: [kind] * spp} | {int(k[1:]): v for k, v in more.items()}
    at, body = 8, b""
    for d in data:
        fields[273].append(at + len(body))
        body += d
    side, entries, base = b"", b"", at + len(body)
    for tag, v in sorted(fields.items()):
        raw = struct.pack(f"{order}{len(v)}I", *v)
        if len(raw) > 4:
            entries += struct.pack(order + "HHII", tag, 4, len(v), base + len(side))
            side += raw
        else:
            entries += struct.pack(order + "HHI", tag, 4, len(v)) + raw.ljust(4, b"\0")
    return (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", base + len(side)) + body + side + struct.pack(order + "H", len(fields)) + entries + b"\0\0\0\0"


def test_op4_kinds_of_samples():
    import numpy as np

    from spanworks.llm.tiff import Page, directories

    rng = np.random.default_rng(3)
    read = lambda raw: [Page(f).read(raw) for f in directories(raw)]
    for order in "<>":
        a = rng.integers(0, 2**16, (5, 7, 3)).astype("u2")
        d = np.diff(a, axis=1, prepend=np.zeros((5, 1, 3), "u2"))
        assert (read(tiff(7, 5, [a.astype(f"{order}u2").tobytes()], order, 16, 3))[0] == a).all()
        assert (read(tiff(7, 5, [d.astype(f"{order}u2").tobytes()], order, 16, 3, predictor=2))[0] == a).all()
        planes = [a[:, :, k].astype(f"{order}u2")[r : r + 2].tobytes() for k in range(3) for r in (0, 2, 4)]
        assert (read(tiff(7, 5, planes, order, 16, 3, planar=2, rows=2))[0] == a).all()
    for bits in (1, 2, 4):
        a = rng.integers(0, 2**bits, (5, 11)).astype("u1")
        each = np.unpackbits(a[:, :, None], axis=2)[:, :, 8 - bits :].reshape(5, -1)
        assert (read(tiff(11, 5, [np.packbits(each, axis=1).tobytes()], bits=bits))[0][:, :, 0] == a).all()
    a = rng.normal(size=(4, 6)).astype("f4")
    split = a.astype(">f4").view("u1").reshape(4, 6, 4).transpose(0, 2, 1).reshape(4, 24)
    raw = np.diff(split, axis=1, prepend=np.zeros((4, 1), "u1")).tobytes()
    assert (read(tiff(6, 4, [raw], bits=32, predictor=3, kind=3))[0][:, :, 0] == a).all()


def test_op4_damage_is_one_row(spark):
    from spanworks.llm import tiff as t

    two = bytearray(t.write_tiff(b"ab  " * (192 * 300 // 4)))
    second = list(t.directories(bytes(two)))[1]
    at = bytes(two).index(second[t.STRIP_OFFSETS][0].to_bytes(4, "little") if t.STRIP_OFFSETS in second and len(second[t.STRIP_OFFSETS]) == 1 else b"\0\0\0\0") if t.STRIP_OFFSETS in second else 0
    images = [tiff(0, 5, [b"x" * 35]), tiff(7, 0, [b"x" * 35]), tiff(2**31, 2**31, [b"x"]), tiff(7, 5, [b"x" * 3]), tiff(7, 5, [b"x" * 35], m322=[0], m323=[16], m324=[8], m325=[35]), tiff(7, 5, [b"x" * 35], predictor=9), tiff(7, 5, [b"x" * 35], m259=[77]), tiff(7, 5, [b"x" * 35], bits=5), bytes(two[: len(two) - 40]), bytes(two[:at] + b"\xff\xff\xff\x7f" + two[at + 4 :])]
    rows = t.read_pages(spark.createDataFrame(list(enumerate(map(bytes, images))), "id long, media binary")).collect()
    assert sorted(r.id for r in rows) == list(range(len(images))) and all(r.error and r.page is None for r in rows)
    assert t.read_pages(spark.createDataFrame([], "id long, media binary")).count() == 0


def test_empty_tables(spark, docs):
    import public_tokenizers

    from spanworks.llm import minhash, pieces, tiff as t

    none = docs.limit(0)
    assert t.media_rows(none).count() == 0 and minhash.near_duplicates(none).count() == 0
    assert pieces.encode_decode(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def test_op4_stored_form(docs, plain):
    """The feature and the digests of the stored form, worked out from the file that each text gives."""
    from spanworks.llm import tiff as t

    got = by_id(t.media_rows(docs).collect())
    for i, text in plain:
        raw = (text or "").encode()
        media = t.write_tiff(raw + b" " * (-len(raw) % 192 if raw else 192))
        pages = [t.Page(f).read(media) for f in t.directories(media)]
        x = [b for p in pages for b in p.ravel().tolist()]
        want = f"pages={len(pages)} size=192x{len(x) // 192} min={min(x)} max={max(x)} mean={sum(x) / len(x):.4f} rms={(sum(b * b for b in x) / len(x)) ** 0.5:.4f}"
        assert (got[i].media_bytes, got[i].media_sha256, got[i].feature) == (len(media), hashlib.sha256(media).hexdigest(), want)


@pytest.mark.parametrize("kw", [{}, {"max_repeat": 1.5}, {"budget": 30000.0}])
def test_op5(docs, plain, kw):
    from spanworks.llm import mixing

    mix = mixing.find_mix(mixing.sized(docs, "doc_id", "text", "source"), **kw)
    size = defaultdict(int)
    for r in docs.select("source", "text").collect():
        size[r.source] += len(words(r.text))
    n = {s: x for s, x in size.items() if x}
    total = sum(n.values())
    raw = {s: (x / total) ** mix.exponent for s, x in n.items()}
    want = {s: x / sum(raw.values()) for s, x in raw.items()}
    rows = mixing.blocks(docs, block_tokens=5000, **kw).collect()
    got, epochs = Counter(), defaultdict(set)
    for r in rows:
        got[r.source] += r.tokens
        epochs[r.source].add(r.epoch)
    longest = max(len(words(t)) for _, t in plain)
    assert all(abs(got[s] - want[s] * mix.budget) <= longest for s in n)
    assert all(want[s] * mix.budget / n[s] <= kw.get("max_repeat", 4.0) * 1.001 for s in n)
    slots = defaultdict(list)
    for r in rows:
        slots[r.block].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    again = Counter(r.source for r in mixing.mixed_documents(docs, **kw).select("source").collect())
    assert again == Counter(r.source for r in rows)
    if "budget" not in kw:
        assert {r.doc_id for r in rows} == {i for i, _ in plain}, "no document is lost"
    assert mixing.blocks(docs.limit(0)).count() == 0


def test_op6(docs, plain):
    import public_tokenizers
    import sentencepiece

    from spanworks.llm import pieces

    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    got = by_id(pieces.digests(pieces.encode_decode(docs, model)).collect())
    for i, t in plain:
        ids = sp.encode(t or "", add_bos=True, add_eos=True)
        want = (len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want
    import random

    random.seed(1)
    alphabet = ["a", " ", "  ", "\n", "\t", "▁", "é", "　", "the", "ing", "\x00", "😀", "</s>", "<0x0A>", "ÿ"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 30))) for _ in range(3000)]
    assert pieces.Segmenter(model, {}).encode(texts) == [pieces.packed(x) for x in sp.encode(texts)]


def test_op7(spark):
    from spanworks.llm.oracles import SQL
    from spanworks.llm.warc import archive_pages

    long = "payload " * 40
    odd = [(9001, None, None), (9002, "u\r\nx: y", ""), (9003, "http://é", long), (9004, "a", long), (9005, "b", "short"), (9006, "c", "short"), (None, "d", long), (9007, "e", "\r\n\r\nWARC/1.1\r\n" * 20)]
    pages = spark.read.parquet(f"{DATA}/pages.parquet").withColumn("digest", F.lit("clash"))
    pages = pages.union(spark.createDataFrame([(*r, "clash") for r in odd], pages.schema))
    got = archive_pages(pages).collect()
    duck = duckdb.connect()
    frame = pages.where("page_id is not null").drop("digest").toPandas()
    duck.register("pages", frame)
    want = duck.execute(SQL["op7_warc_normaliser"]).fetchall()
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(map(key, want)) == sorted(key((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got if r.page_id is not None)
    assert [r.record_type for r in got if r.page_id is None] == ["response"]
    assert archive_pages(pages.limit(0)).count() == 0


def test_op7_normaliser_reads_members_and_refuses_damage(spark, tmp_path):
    import gzip

    from spanworks.llm import warc

    one, two = warc.record(1, "u", b"x" * 300_000, None), warc.record(2, "v", b"", None)
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(one) + gzip.compress(two))
    (tmp_path / "empty.warc.gz").write_bytes(gzip.compress(b""))
    (tmp_path / "bad.warc.gz").write_bytes(gzip.compress(one[:1000]))
    files = lambda *n: spark.createDataFrame([(f"{tmp_path}/{x}.warc.gz",) for x in n], "file string")
    index = warc.normalise(files("a", "empty"), f"file://{tmp_path}/out").collect()
    assert len(index) == 2
    for r in index:
        raw = open(r.file, "rb").read()[r.offset : r.offset + r.length]
        assert gzip.decompress(raw) in (one, two)
    with pytest.raises(Exception, match="ends inside a record"):
        warc.normalise(files("bad"), f"file://{tmp_path}/out").collect()


def test_op8(docs, plain):
    from spanworks.llm.sharding import shard

    def jump(key, n):
        b, j = -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
        return b

    rows = shard(docs, 40).collect()
    assert len(rows) == len(plain)
    slots = defaultdict(list)
    for r in rows:
        k = (r.doc_id or 0) % 2**64
        assert (r.shard, r.grown_shard) == (jump(k, 40), jump(k, 41)) and r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    text = dict(plain)
    assert all(r.size == len((text[r.doc_id] or "").encode()) + 16 and r.text_crc32 == zlib.crc32((text[r.doc_id] or "").encode()) for r in rows)
    assert shard(docs.limit(0), 40).count() == 0


def test_op9(docs, plain):
    from spanworks.llm.debruijn import digests, remove_repeats

    cleaned = remove_repeats(docs)
    assert set(cleaned.columns) == {*docs.columns, "n_removed"}
    got = by_id(digests(cleaned).collect())
    seen = set()
    for i, t in sorted({x for x in plain}, key=lambda x: (x[0] is not None, x[0] or 0)):
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            k = tuple(w[p : p + 20])
            if k in seen:
                gone[p : p + 20] = [True] * 20
            seen.add(k)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    assert remove_repeats(docs.limit(0)).count() == 0


def test_op9_paths_stand_at_both_places(docs, plain):
    from spanworks.llm.debruijn import repeated_paths

    text = {-(2**63) if i is None else i: words(t) for i, t in plain}
    rows = repeated_paths(docs).collect()
    assert rows and len({(r.doc, r.lo, r.from_doc, r.from_lo) for r in rows}) == len(rows)
    ends = {(r.doc, r.hi, r.from_doc, r.from_lo + r.hi - r.lo) for r in rows}
    for r in rows:
        n = r.hi - r.lo + 1
        assert n >= 20 and (r.from_doc, r.from_lo) < (r.doc, r.lo)
        assert text[r.doc][r.lo : r.hi + 1] == text[r.from_doc][r.from_lo : r.from_lo + n]
        assert (r.doc, r.lo + 18, r.from_doc, r.from_lo + 18) not in ends, "adjoining parts are one path"


def test_op9_overfull_filter_changes_nothing(docs, monkeypatch):
    from spanworks.llm import debruijn

    want = sorted((r.doc_id or -1, r.kept_sha256) for r in debruijn.digests(debruijn.remove_repeats(docs)).collect())
    monkeypatch.setattr(debruijn, "FILTER_BYTES", 512)
    monkeypatch.setattr(debruijn, "GROUP_SEEDS", 50)
    monkeypatch.setattr(debruijn, "HOT_SEEDS", 20)
    monkeypatch.setattr(debruijn, "BROADCAST_ROWS", 5)
    assert want == sorted((r.doc_id or -1, r.kept_sha256) for r in debruijn.digests(debruijn.remove_repeats(docs)).collect())


@pytest.mark.parametrize("small, block", [(64, 1000), (1, 2)])
def test_op10(spark, docs, plain, monkeypatch, small, block):
    from spanworks.llm import minhash

    monkeypatch.setattr(minhash, "SMALL_BAND", small)
    monkeypatch.setattr(minhash.links_across, "__defaults__", (block,))
    import random

    random.seed(4)
    seed = [f"t{k}" for k in range(80)]
    group = []
    for k in range(40):  # copies that drift apart: some are linked only through others
        seed = list(seed)
        seed[random.randrange(80)] = f"n{k}"
        group.append((8000 + k, " ".join(seed)))
    rows = docs.select("doc_id", "text").union(spark.createDataFrame(group, "doc_id long, text string"))
    got = by_id(minhash.near_duplicates(rows).collect())
    sets = {}
    for i, t in [*plain, *group]:
        w = words(t, True)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    assert got[None].component_id is None and got[None].kept
    ids = sorted(i for i in sets if i is not None)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if b < a and x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * (n := len(x & y)) >= 75 * (len(x) + len(y) - n):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    assert {i: got[i].component_id for i in ids} == {i: find(i) for i in ids}
    assert all(got[i].n_shingles == len(sets[i]) and got[i].kept == (find(i) == i) for i in ids)


@pytest.mark.parametrize("broadcast", [1_000_000, 10])
def test_components(spark, monkeypatch, broadcast):
    import random

    from spanworks.llm import minhash
    from spanworks.llm.minhash import components

    monkeypatch.setattr(minhash, "BROADCAST_ROWS", broadcast)
    monkeypatch.setattr(minhash, "HUB", 50)
    random.seed(2)
    edges = [(k, k + 1) for k in range(0, 200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(random.randint(2000, 2300), random.randint(2000, 2300)) for _ in range(150)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)


def test_op8_string_ids(spark):
    from spanworks.llm.sharding import shard

    rows = shard(spark.createDataFrame([(x, "t") for x in ["a", "b", "7", None, "a"]], "doc_id string, text string"), 4).collect()
    assert len(rows) == 5 and all(r.grown_shard in (r.shard, 4) for r in rows) and len({r.shard for r in rows if r.doc_id == "a"}) == 1


def plain_statistics(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    c = Counter(tri)
    covered = {k + d for k, x in enumerate(tri) if c[x] > 1 for d in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, r = len(w), len(covered)
    failed = n < 50 or 100 * r > 50 * n
    ratio = lambda x: x / n if n else 0.0
    return failed, {"symbols_per_word": ratio(len(re.findall(r"[#*$%&|<>]", t or ""))), "long_words": ratio(sum(map(len, w))), "repeat_words": ratio(r), "dup_lines": ratio(len(lines) - len(set(lines)))}


def test_pipeline_against_a_plain_version(spark, tmp_path):
    """Quality, near-duplicates, repeated passages and ids in plain Python, on the smallest documents and odd rows."""
    import random

    import public_tokenizers
    import sentencepiece

    import corpus_pipeline as p
    from spanworks.llm import mixing

    random.seed(6)
    new = lambda n: " ".join("".join(random.choices("abcdefgh", k=6)) for _ in range(n))
    base, passage = new(200), new(60)
    odd = [(None, new(80)), (9001, None), (9002, ""), (9003, new(70_000)), (9004, base), (9004, base), (9005, base), (9006, base + " x"), (9007, passage + " " + new(60)), (9008, new(60) + "\n" + passage), (9009, "new line\n" * 60), (None, new(80))]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = docs.union(spark.createDataFrame([(i, t, "en", "src1" if k % 2 else None, None) for k, (i, t) in enumerate(odd)], docs.schema))
    clash = ["n_words", "_w", "symbols_per_word", "_source", "_full", "_raw", "kept", "row", "doc", "stratum", "key", "block", "text_key", "component"]
    docs = docs.withColumns({c: F.lit("own") for c in clash})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")

    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and not r.toxic}
    stats = [plain_statistics(t) for _, t, _ in rows]
    cuts = plain_cutoffs({(g, t): (g, s) for (i, t, g), (bad, s) in zip(rows, stats) if i in good and not bad}.values())
    kept = [(i, t) for (i, t, g), (bad, s) in zip(rows, stats) if not bad and not any(x >= cuts.get((g, k), math.inf) for k, x in s.items())]
    sets = {}
    for i, t in kept:
        w = words(t, True)
        sets.setdefault(i, set()).update(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    ids = sorted(i for i in sets if i is not None)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if b < a and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and 100 * (n := len(x & y)) >= 75 * (len(x) + len(y) - n):
                q, r = find(a), find(b)
                root[max(q, r)] = min(q, r)
    kept = [(i, t) for i, t in kept if i is None or find(i) == i]
    seen, clean = {}, Counter()
    for i, t in sorted(set(kept), key=lambda x: (x[0] is not None, x[0] or 0)):  # ids without a number tie; their texts share nothing here
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            if seen.setdefault(tuple(w[k : k + 20]), (i, k)) != (i, k):
                gone[k : k + 20] = [True] * 20
        clean[i, b" ".join(x for x, g in zip(w, gone) if not g).decode()] += kept.count((i, t))

    step = p.quality_rules(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert step.columns == docs.columns
    step = p.near_duplicates(spark, step, str(tmp_path))
    step = p.substring_dedup(spark, step, str(tmp_path))
    assert step.columns == docs.columns and Counter((r.doc_id, r.text) for r in step.collect()) == clean
    assert all(r[c] == "own" for r in step.limit(20).collect() for c in clash)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids_of = lambda t: b"".join(x.to_bytes(4, "little") for x in sp.encode(t, add_bos=True, add_eos=True))
    text = {i: t for i, t in clean if i is not None}
    want = Counter(r.doc_id for r in mixing.blocks(step, p.ENTROPY_SHARE, p.MAX_REPEAT).collect())
    got = p.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in got) == want
    assert all(bytes(r.ids) == ids_of(text[r.doc_id]) for r in got if r.doc_id is not None)
    assert {bytes(r.ids) for r in got if r.doc_id is None} == {ids_of(t) for i, t in clean if i is None}


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline as p

    spark.read.parquet(f"{DATA}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{DATA}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert p.run(spark, str(tmp_path)).count() == 0


def test_mixed_documents_in_block_order(spark):
    """The stage writes what ``blocks`` deals, in the order of blocks and slots."""
    import corpus_pipeline as p
    from spanworks.llm import mixing

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    dealt = mixing.blocks(docs, p.ENTROPY_SHARE, p.MAX_REPEAT).orderBy("block", "slot").collect()
    assert [r.doc_id for r in p.mix_sources(spark, docs, DATA).collect()] == [r.doc_id for r in dealt]
    for kw in ({"block_tokens": 3000}, {"block_tokens": 700, "max_repeat": 1.5}, {"block_tokens": 3000, "budget": 20000.0}):
        dealt = mixing.blocks(docs, **kw).orderBy("block", "slot").collect()
        mixed = mixing.mixed_documents(docs, **kw)
        assert mixed.columns == docs.columns and len({r.block for r in dealt}) > 3
        assert [(r.doc_id, r.source) for r in mixed.collect()] == [(r.doc_id, r.source) for r in dealt]
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in p.STAGES] == ["quality_rules", "near_duplicates", "substring_dedup", "mix_sources", "encode_pieces"]
    kept = p.quality_rules(spark, docs, DATA)
    assert kept.columns == docs.columns
    unique = p.near_duplicates(spark, kept, DATA)
    texts = Counter(r.text for r in unique.collect())
    assert max(texts.values()) == 1 and unique.columns == docs.columns
    clean = p.substring_dedup(spark, unique, DATA)
    assert clean.columns == docs.columns and clean.count() == unique.count()
    assert all(r.n_chars == len(r.text) for r in clean.collect())
    mixed = p.mix_sources(spark, clean, DATA)
    ids = {r.doc_id for r in clean.collect()}
    assert {r.doc_id for r in mixed.collect()} == ids and mixed.count() >= len(ids)
    out = p.run(spark, DATA)
    assert {r.doc_id for r in out.select("doc_id").collect()} == ids and out.count() == mixed.count()
