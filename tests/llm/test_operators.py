"""The training-data operators against brute force, and on nulls, empty texts, ties, repeated rows, empty tables and extra columns."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import struct
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanspark.llm import ann, bpe, chat, exact_dedup, lm, mixing, secrets, simhash, token_files, toxicity
from gleanspark.llm.common import new_folder, written

BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, digest string, size long, fps string"
AWKWARD = [None, "", " ", "a", "\t\n", "a  b　c", "don't  <|endoftext|> stop", "x" * 5000, "漢字" * 1500, "é" * 40 + "!!\n\n 12", "word. Next,\nLine.\nMore " * 300, "AKIA" + "A" * 16]


@pytest.fixture(scope="module")
def docs(spark):
    random.seed(3)
    words = [f"w{i}" for i in range(60)]
    texts = AWKWARD + [" ".join(random.choices(words, k=random.randint(1, 90))) for _ in range(60)]
    rows = [(i, t, f"s{i % 4}" if i % 9 else None, "x", 5, "y") for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], rows[0], (None, "no id here", "s1", None, None, None), (500, "  " + texts[30].replace(" ", "\n"), "s2", None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def plain(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


# 1

def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string")


def test_chat_texts_come_back_and_the_machine_agrees_in_any_blocks(spark):
    hard = ["", None, "\\", "### User: hi</turn>\n", "\\b\\c\\d", "### ", "</turn>", "a: b", "\\### Assistant: </turn> ok"]
    rows = [(c, t, ["user", "assistant"][t % 2], hard[(c + t) % len(hard)], "x") for c in range(9) for t in range(2 * c + 2)]
    rows += [(50, 0, "assistant", "first", None), (51, None, None, None, None), (51, 3, "robot: x", "y", None), (52, 0, "user", "q", None), (53, 0, "user", "same", None), (53, 0, "user", "same", None)]
    outs = [chat.format_chats(chats(spark, rows), block_turns=b).withColumn("all", chat.formatted(F.col("segments"))).withColumn("back", chat.read_back(F.col("all"))).orderBy("conv_id").collect() for b in (256, 3)]
    assert outs[0] == outs[1]
    for r in outs[0]:
        own = sorted(((-1 if t is None else t), role or "", text or "") for c, t, role, text, _ in rows if c == r["conv_id"])
        assert [(b["role"], b["text"]) for b in r["back"]] == [x[1:] for x in own]
        assert r["n_turns"] == len(own)
        roles = [x[1] for x in own]
        assert r["valid"] == (roles == ["user", "assistant"] * (len(roles) // 2) and bool(roles))
        assert sum(s["loss"] for s in r["segments"]) == roles.count("assistant")
    bad = {r["conv_id"]: r["bad_turn"] for r in outs[0]}
    assert (bad[50], bad[51], bad[52], bad[53]) == (0, -1, None, 0)


def test_chat_of_nothing(spark):
    assert chat.format_chats(chats(spark, [])).count() == 0


# 2

def toxic_docs(spark, n=1500):
    random.seed(5)
    words, bad = [f"w{i}" for i in range(300)], ["vile", "awful", "nasty"]
    rows = []
    for i in range(n):
        own = random.choices(words, k=60)
        if i % 5 == 0:
            own[:1 + i % 3 * 3] = random.choices(bad, k=1 + i % 3 * 3)
        random.shuffle(own)
        rows.append((i, " ".join(own), int(i % 5 == 0)))
    return rows


def test_toxicity_on_rows_it_has_not_seen(spark):
    rows = toxic_docs(spark)
    docs = spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows] + [(9000, None, 1.0), (9001, "", 1.0), (None, "vile awful nasty vile", 1.0)], "doc_id long, text string, severity double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 1200] + [(1, None), (None, 1), (12345, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.grade_documents(docs, labels).collect()}
    assert len(got) == len(rows) + 3
    right = [got[i]["rejected"] == bool(y) for i, _, y in rows if i >= 1200]
    assert sum(right) / len(right) > 0.97
    assert not got[9000]["rejected"] and not got[9001]["rejected"] and got[None]["rejected"]
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["rejected"]}


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["rejected"] for r in toxicity.grade_documents(docs, labels).collect()] == [False, False]
    assert toxicity.grade_documents(docs.limit(0), labels).count() == 0


def test_ordinal_gradient_and_order():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (3000, 6))
    latent = x @ np.array([2.0, -1, 0, 0, 1, 0]) + rng.logistic(size=3000)
    grade = np.digitize(latent, [0.5, 2.0, 3.0])
    row, col = np.nonzero(x)
    w, t = toxicity.fit_ordinal(row, col, grade, 6, ridge=1e-6)
    assert np.all(np.diff(t) > 0) and abs(w - [2, -1, 0, 0, 1, 0]).max() < 0.25 and abs(t - [0.5, 2, 3]).max() < 0.3


# 3 and 8

def test_encoding_equals_the_library(docs, none):
    t = Tokenizer.from_file(BPE)
    for chars in (32_768, 50):
        got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.encode_digest(docs, BPE, segment_chars=chars).collect()), key=repr)
        want = []
        for i, text in plain(docs):
            ids = t.encode(text, add_special_tokens=False).ids
            want.append((i, len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(t.decode(ids, skip_special_tokens=False))))
        assert got == sorted(want, key=repr)
    assert bpe.encode_digest(none, BPE).count() == 0


def test_ids_go_round(docs):
    ids = bpe.encode_ids(docs, BPE).withColumn("back", bpe.decode_ids(F.col("ids"), BPE))
    assert sorted(((r["doc_id"], r["back"]) for r in ids.collect()), key=repr) == sorted(plain(docs), key=repr)


@pytest.mark.parametrize("leaf", [1, 3, 16])
def test_trees_of_random_strings(monkeypatch, leaf):
    monkeypatch.setattr(bpe, "LEAF_BYTES", leaf)
    e, t, rng = bpe.Encoder(BPE, public_tokenizers.PATTERN), Tokenizer.from_file(BPE), random.Random(leaf)
    parts = [" ", "  ", "\n", "a", "ing", "'s", "'", "!", "é", "漢字", "😀", "12", "<|endoftext|>", "　", "\r\n", ".", "xxxx"]
    for _ in range(400):
        s = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        for chars in (1, 5, 20):
            assert e.joined([(e.encode_segment(p, r), r) for p, r in e.segments(s, chars)]) == t.encode(s, add_special_tokens=False).ids


def test_token_files(spark, docs, none):
    out = new_folder(spark, "test-tokens")
    token_files.write_tokens(docs, out, BPE, end_id=2, files=3)
    t = Tokenizer.from_file(BPE)
    hashes = {r[0]: r[1] for r in docs.select(F.coalesce("text", F.lit("")), F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
    got = sorted(token_files.ids_crc32(token_files.with_starts(token_files.read_tokens(spark, out))).collect(), key=lambda r: r["start"])
    stream, at = sorted(plain(docs), key=lambda x: (x[0] is not None, x[0] or 0, hashes[x[1]])), 0
    for r, (i, text) in zip(got, stream, strict=True):
        ids = [*t.encode(text, add_special_tokens=False).ids, 2]
        assert tuple(r) == (i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        at += len(ids)
    plan = token_files.read_tokens(spark, out).filter("doc_id = 30")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,30)" in plan
    token_files.write_tokens(none, out + "-none", BPE)
    assert token_files.read_tokens(spark, out + "-none").count() == 0


# 4

def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 24))
    x = centres[rng.integers(0, 8, 1500)] + 0.5 * rng.normal(size=(1500, 24))
    x[200:400] = x[200]  # one very common vector
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x.astype(np.float32).astype(float))]
    odd = [(2000, None, ""), (2020, [0.0] * 24, ""), (2040, [1.0, None] * 12, ""), (2060, [float("nan")] * 24, ""), (2080, [1.0], ""), (None, [1.0] * 24, "")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, cell string")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 1500, 20))
    v, hits = np.array([r[1] for r in rows]), 0
    for q, found in got.items():
        s = (v * v[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and all(f[2] == s[f[1]] for f in found)
        assert found == [(n + 1, *x) for n, x in enumerate(sorted([f[1:] for f in found], key=lambda f: (-f[1], f[0])))]
        hits += len({f[1] for f in found} & set(order))
    assert hits / 20 / len(got) >= 0.95
    assert ann.nearest(df.filter("vec_id <= 10"), F.col("vec_id") == 0).count() == 10
    assert ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_chi_square_quantile():
    assert abs(ann.chi_square_quantile(0.95, 10) - 18.307) < 1e-3 and abs(ann.chi_square_quantile(0.9, 16) - 23.542) < 1e-3


# 5

def test_mixing_by_hand(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1), (None, 100), ("d", 0)], "source string, size long")
    got = {r["source"]: (r["weight"], r["target"]) for r in mixing.source_targets(sizes).collect()}
    # caps 30, 3000, 3, 0, 300 with weights 1, 2, 3, 1, 2: b takes what is left
    assert got == {"a": (1, 30.0), "b": (2, 1111 - 333.0), "c": (3, 3.0), "d": (1, 0.0), None: (2, 300.0)}


def test_mixing_is_near_its_targets(spark, docs, none):
    rows = mixing.copies(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))).collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((i, len(WORD.findall(t))) for i, t in plain(docs))
    most = max(r["size"] for r in rows)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 3 * most and all(r["taken"] <= 3 * r["size"] for r in own)
    again = mixing.copies(docs.repartition(2).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), parts=3).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in rows) and mixing.mix(none).count() == 0


# 6

def simhash_plain(text, width=3):
    import xxhash
    w = text.encode().lower().split()
    s = [b" ".join(w[i:i + width]) for i in range(len(w) - width + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, limit=2):
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a, b in itertools.combinations(sorted(fps), 2):
        if (a ^ b).bit_count() <= limit:
            parent[root(a)] = root(b)
    return {f: root(f) for f in fps}


def test_fingerprints(docs, none):
    got = Counter((r["doc_id"], r["fps"][0] % (1 << 64)) for r in simhash.fingerprints(docs).collect())
    assert got == Counter((i, simhash_plain(t)) for i, t in plain(docs))
    assert simhash.fingerprints(none).count() == 0


@pytest.mark.parametrize("paired", [0, 3, 10_000])
def test_links_keep_components(spark, paired):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {0, (1 << 64) - 1, *base}
    for f in base:
        for _ in range(25):
            f ^= 1 << rng.randrange(64) | (1 << rng.randrange(64) if rng.random() < 0.6 else 0)
            fps.add(f)
    rows = [(i, simhash._signed(f)) for i, f in enumerate(sorted(fps, key=lambda _: rng.random()))]
    edges = simhash.links(spark.createDataFrame([(f,) for _, f in rows], "fp long"), paired)
    nodes = spark.createDataFrame([(f, i) for i, f in rows], "node long, least long")
    found = {r["node"]: r["smallest"] for r in simhash.components(nodes, edges).collect()}
    want, least = brute_components({f % (1 << 64) for _, f in rows}), {}
    for i, f in rows:
        least[want[f % (1 << 64)]] = min(i, least.get(want[f % (1 << 64)], i))
    assert {f: found.get(f, i) for i, f in rows} == {f: least[want[f % (1 << 64)]] for _, f in rows}


def test_a_chain_too_long_fails(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    nodes = spark.range(201).select(F.col("id").alias("node"), F.col("id").alias("least"))
    with pytest.raises(RuntimeError, match="raise max_rounds"):
        simhash.components(nodes, edges, max_rounds=2)
    assert simhash.components(nodes, edges).agg(F.max("smallest")).first()[0] == 0


def near_plain(rows):
    """(id, text) of the rows that stay, by all pairs."""
    distinct = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    fps = [simhash_plain(t) for _, t in distinct]
    left, kept = set(range(len(distinct))), []
    while left:
        group, todo = set(), [min(left)]
        while todo:
            i = todo.pop()
            if i in left:
                left.discard(i)
                group.add(i)
                todo += [j for j in left if (fps[i] ^ fps[j]).bit_count() <= 2]
        kept.append({distinct[i] for i in group if distinct[i][0] == distinct[min(group)][0]})
    return kept


def near_copies(seed=8, groups=12, words=300):
    rng, out = random.Random(seed), []
    for g in range(groups):
        base = [f"v{rng.randrange(5000)}" for _ in range(words)]
        for k in range(30 if g == 0 else 3):
            own = list(base)
            for _ in range(k and 1):
                own[rng.randrange(words)] = f"v{rng.randrange(5000)}"
            out.append((g * 100 + k, " ".join(own)))
    return out


def test_near_dedup(spark, docs, none):
    df = docs.unionByName(spark.createDataFrame([(i + 1000, t, "s", None, None, None) for i, t in near_copies()], SCHEMA))
    out = simhash.near_dedup(df)
    assert out.columns == docs.columns and simhash.near_dedup(none).count() == 0
    got, groups = plain(out), near_plain(plain(df))
    assert len(got) == len(groups) and all(sum(r in g for r in got) == 1 for g in groups)
    assert len(groups) < len(set(plain(df)))


# the pipeline

def test_pipeline_on_awkward_rows(spark, docs, tmp_path):
    rows = near_copies(4) + [(7000 + i, f"some words stand here {i} times over") for i in range(40)]
    df = docs.unionByName(spark.createDataFrame([(i + 1000, t, f"s{i % 3}", None, None, None) for i, t in rows], SCHEMA)).withColumn("member", F.lit(1)).withColumn("rows", F.lit("x"))
    folder = f"file://{tmp_path}"
    labels = spark.range(1000, 1100).selectExpr("id doc_id", "1 quality", "cast(id % 2 as int) toxic")
    df.write.parquet(f"{folder}/documents.parquet")
    labels.limit(0).write.parquet(f"{folder}/labels.parquet")
    kept, before = df, df.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = written(stage(spark, kept, folder), name)
        assert after.columns == df.columns and after.subtract(df).isEmpty()
        if name == "exact_dedup":
            norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
            assert Counter(norm(t) for _, t in plain(after)) == Counter({norm(t) for _, t in plain(kept)})
        if name == "simhash_dedup":
            groups = near_plain(plain(kept))
            assert after.count() == len(groups) < kept.count()
        kept, before = after, after.count()
    assert corpus_pipeline.run(spark, folder).count() >= before // 3
    df.limit(0).write.parquet(f"{folder}/none/documents.parquet")
    labels.limit(0).write.parquet(f"{folder}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{folder}/none").count() == 0


# 7

def test_exact_dedup(docs, none):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    for counters in (1, 1_000):
        got = exact_dedup.group_members(exact_dedup.document_digests(docs), counters)[0].collect()
        groups = {}
        for i, t in plain(docs):
            groups.setdefault(sha(norm(t)), []).append(i)
        assert Counter((r["doc_id"], r["digest"]) for r in got) == Counter((i, d) for d, ids in groups.items() for i in ids)
        for d, ids in groups.items():
            own = [r for r in got if r["digest"] == d]
            first = min((i for i in ids if i is not None), default=None)
            assert {(r["keep_id"], r["group_size"]) for r in own} == {(first, len(ids))} and sum(r["kept"] for r in own) == 1
            assert [r["doc_id"] for r in own if r["kept"]] == [first]
        kept = exact_dedup.exact_dedup(docs, counters=counters)
        assert kept.columns == docs.columns and Counter(sha(norm(t)) for _, t in plain(kept)) == Counter(list(groups))
    assert exact_dedup.exact_dedup(none).count() == 0


def test_heavy_hitters_are_named(spark):
    keys = spark.createDataFrame([("hot",) if i % 3 == 0 else (f"k{i}",) for i in range(3000)], "digest string").repartition(9)
    found = [r["digest"] for r in exact_dedup.heavy_hitters(keys, "digest", 5).collect()]
    assert "hot" in found and len(found) <= 5


# 9

def test_lm_scores_by_plain_counts(docs, none, monkeypatch):
    rows = [(i, [w.decode() for w in t.encode().lower().split()] + [None]) for i, t in plain(docs)]
    fold = lambda i: zlib.crc32(str(i).encode()) % 10 if i is not None else 0
    c, pairs, heads = Counter(), Counter(), Counter()
    for i, w in rows:
        if fold(i):
            c.update(w)
            pairs.update(zip([None, *w], w, strict=False))
            heads.update([None, *w][:-1])
    n, v = sum(c.values()), len(c)
    seen = {}
    monkeypatch.setattr(lm, "learned_weights", lambda *a, real=lm.learned_weights: seen.setdefault("w", real(*a)))
    for tokens in (1_500_000, 200):
        monkeypatch.setattr(lm, "BLOCK_TOKENS", tokens)
        monkeypatch.setattr(lm, "GROUP_TOKENS", tokens)
        got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["held_out"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in lm.score(docs).collect()), key=repr)
        w_ = seen.pop("w")
        assert abs(w_.sum(axis=1) - 1).max() < 1e-9 and (w_ >= 0).all()
        want = []
        for i, w in rows:
            base = sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
            score = 0.0
            for h, x in zip([None, *w], w, strict=False):
                a, b, u = w_[min(1 + heads[h].bit_length() - 1, lm.BUCKETS - 1) if heads[h] else 0]
                score += math.log10((a * pairs[h, x] / heads[h] if heads[h] else 0) + b * c[x] / n + u / (v + 1))
            want.append((i, len(w), sum(c[x] > 0 for x in w), fold(i) == 0, n, round(base, 6), round(score, 6)))
        assert got == sorted(want, key=repr)
    assert lm.score(none).count() == 0


# 10

def test_secrets_and_the_ledger(spark, docs, none):
    planted = ["my Password = 'hunter22' and token: abc", "api_key=ABCDEF123 apikey: short", "é AKIA" + "B" * 16 + " " + "0123456789abcdef" * 2, "token: token=abcdefg", "paſsword=longenough"]
    df = docs.unionByName(spark.createDataFrame([(700 + i, t, None, None, None, None) for i, t in enumerate(planted)], SCHEMA))
    ledger = secrets.Ledger(new_folder(spark, "test-ledger"))
    rules = [(r.kind, re.compile(r.pattern, r.flags), r.least, r.group) for r in secrets.RULES]

    def brute(text):
        return sorted((m.start(), k + 1, m.end()) for k, (_, p, least, group) in enumerate(rules) for m in p.finditer(text) if len(m[group]) >= least)

    def found(rows):
        return Counter((r["doc_id"], tuple(tuple(f) for f in r["found"])) for r in rows)

    want = Counter((i, tuple(brute(t))) for i, t in plain(df))
    assert found(secrets.scan(df, ledger).collect()) == want and sum(bool(s) for _, s in want) >= 4
    scanned = ledger.read(spark, "scanned", secrets.SCANNED)
    pairs = scanned.count()
    assert pairs == 3 * len({t for _, t in plain(df)})
    # a second run has nothing new to scan, a new version of one text has one, a new rule has every blob
    assert found(secrets.scan(df, ledger).collect()) == want and ledger.read(spark, "scanned", secrets.SCANNED).count() == pairs
    more = df.unionByName(spark.createDataFrame([(700, "secret=changed99", None, None, None, None)], SCHEMA))
    secrets.scan(more, ledger)
    assert ledger.read(spark, "scanned", secrets.SCANNED).count() == pairs + 3
    secrets.scan(more, ledger, rules=(*secrets.RULES, secrets.Rule("pem", "-----BEGIN [A-Z ]+-----", 10)))
    assert ledger.read(spark, "scanned", secrets.SCANNED).count() == (pairs + 3) * 4 // 3
    assert secrets.scan(none, secrets.Ledger(new_folder(spark, "test-ledger"))).count() == 0


# all

def test_entry_lists_all():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 11)) and "pipeline" in names
