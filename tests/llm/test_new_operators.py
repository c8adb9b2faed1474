"""Operators 11 to 13 against brute force, the registered queries included, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from test_operators import AWKWARD, BPE, SCHEMA, docs, near_copies, none, plain  # noqa: F401
from tokenizers import Tokenizer

from gleanspark.llm import alignment, importance, minhash
from gleanspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# 11

@pytest.fixture(scope="module")
def both():
    a, b = Tokenizer.from_file(BPE), SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    from gleanspark.llm.bpe import byte_alphabet

    to_byte = {c: i for i, c in enumerate(byte_alphabet())}

    def tokens(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text, num_threads=1)
        bytes_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        want = (" " + text).encode()
        return None if not text or b"".join(bytes_a) != want or b"".join(bytes_b) != want else (ids_a, bytes_a, ids_b, bytes_b)

    return tokens


def spans(parts):
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return list(zip([0, *ends[:-1]], ends, strict=True))


def aligned_plain(rows, tokens):
    told, holds = [], Counter()
    for i, text in rows:
        found = tokens(text)
        if found is None:
            told.append((i, 0, 0, 0, [], ""))
            continue
        ids_a, bytes_a, ids_b, bytes_b = found
        at_a, at_b = spans(bytes_a), spans(bytes_b)
        links, first = [], 0
        for x, (s, e) in zip(ids_a, at_a, strict=True):
            while at_b[first][1] <= s:
                first += 1
            j = first
            while j < len(at_b) and at_b[j][0] < e:
                links.append((x, ids_b[j]))
                j += 1
        shared = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups = defaultdict(lambda: ([], []))
        for side, (ids, at) in enumerate([(ids_a, at_a), (ids_b, at_b)]):
            cut = 0
            for x, (_, e) in zip(ids, at, strict=True):
                while shared[cut] < e:
                    cut += 1
                groups[shared[cut]][side].append(x)
        name = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for _, g in sorted(groups.items()))
        holds.update(set(links))
        told.append((i, len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(name.encode()).hexdigest()))
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    return Counter((i, n_a, n_b, g, len(links), sum(holds[p] == most[p[0]] for p in links), sum(holds[p] for p in links), sha) for i, n_a, n_b, g, links, sha in told)


FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment(spark, docs, none, both):  # noqa: F811
    more = ["▁ x▁y", " lead  and trail ", "a\x00b c", "<s> </s> <unk> <0x0A>", "ﬁ Å é naïve", "tab\tnew\nline \n end", "😀 smile 😀😀", "x ", "  ", "\n", "日本 語 " * 9]
    df = docs.unionByName(spark.createDataFrame([(900 + i, t, "s", None, None, None) for i, t in enumerate(more)], SCHEMA))
    got = alignment.align(df, BPE, PIECES)
    assert Counter(map(tuple, got.select(FIELDS).collect())) == aligned_plain(plain(df), both)
    assert alignment.align(none, BPE, PIECES).count() == 0


def test_alignment_query(spark, both):
    assert Counter(map(tuple, QUERIES["op11_alignment"](spark, SF).select(FIELDS).collect())) == aligned_plain(plain(given(spark)), both)


def test_windows_of_a_model_that_goes_past_spaces(monkeypatch):
    monkeypatch.setattr(SentencePieceProcessor, "id_to_piece", lambda self, i: "a▁b")
    with pytest.raises(ValueError, match="past a space"):
        alignment.Pieces(PIECES)


# 12

def set_of(text, width=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def linked_plain(rows, num=80, den=100, width=2):
    sets = [set_of(t, width) for _, t in rows]
    at = list(range(len(rows)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if den * min(len(sets[i]), len(sets[j])) >= num * max(len(sets[i]), len(sets[j]), 1):
                common = len(sets[i] & sets[j])
                if den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                    at[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return Counter((d, len(sets[i]), d if not sets[i] else least.get(root(i)), d == (d if not sets[i] else least.get(root(i)))) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("paired", [32, 2])
def test_near_copies(spark, docs, none, monkeypatch, paired):  # noqa: F811
    """paired = 2: bands of three sets and more are compared in blocks."""
    monkeypatch.setattr(minhash, "PAIRED", paired)
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng, family = random.Random(5), []
    # a family around the limit, where the smallest member is like some of the others only
    base = [f"f{i}" for i in range(120)]
    for k in range(40):
        own = list(base)
        for _ in range(7):
            own[rng.randrange(120)] = f"g{rng.randrange(9999)}"
        family.append((3000 + k, " ".join(own).upper() if k % 5 == 0 else " ".join(own)))
    rows = [(i + 1000, t) for i, t in near_copies()] + family + [(4000, "One two"), (4001, "one  TWO"), (4002, "one two one two"), (4003, "One"), (4004, "oNE")]
    df = docs.unionByName(spark.createDataFrame([(i, t, "s", None, None, None) for i, t in rows], SCHEMA))
    want = linked_plain(plain(df))
    got = minhash.near_copies(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert Counter(map(tuple, got.collect())) == want
    assert len({c for _, _, c, _ in want if c is not None and 3000 <= c < 3040}) > 1
    assert minhash.near_copies(none).count() == 0


def test_near_copies_query(spark):
    assert Counter(map(tuple, QUERIES["op12_minhash"](spark, SF).collect())) == linked_plain(plain(given(spark)))


def test_sketches_fill_and_agree_as_sets_do():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    size, off = 200, []
    for common, own in [(1, 0), (3, 1), (40, 5), (300, 60), (2000, 700)]:
        for _ in range(20):
            some = rng.permutation(pool)[:common + 2 * own]
            x, y = np.sort(some[:common + own]), np.sort(np.concatenate([some[:common], some[common + own:]]))
            both = minhash.sketches(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]), size)
            assert (both != minhash._EMPTY).all()
            # the same whatever else is in the batch
            assert (both[:1] == minhash.sketches(x, np.array([0, len(x)]), size)).all()
            off.append((both[0] == both[1]).mean() - common / (common + 2 * own))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 1.2 * math.sqrt(0.25 / size)
    assert (minhash.sketches(np.zeros(0, np.uint64), np.array([0, 0]), size) == minhash._EMPTY).all()


def test_bands_find_pairs_at_the_limit():
    rng = np.random.default_rng(2)
    bands = minhash.bands_for(0.8)
    assert (1 - 0.8 ** minhash.ROWS) ** bands <= 4e-6
    met = 0
    for _ in range(400):
        some = rng.integers(0, 1 << 63, 120).astype(np.uint64)
        x, y = np.sort(some[:108]), np.sort(np.concatenate([some[:96], some[108:]]))
        a, b = minhash.sketches(np.concatenate([x, y]), np.array([0, 108, 216]), bands * minhash.ROWS)
        met += any((a[i * minhash.ROWS:(i + 1) * minhash.ROWS] == b[i * minhash.ROWS:(i + 1) * minhash.ROWS]).all() for i in range(bands))
    assert met == 400


# 13

def resampled_plain(rows, target, percent, least, longest, buckets, seed=2024):
    def found(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    own, wanted = [found(t) for _, t in rows], Counter(b for t in target for b in found(t)[1])
    have = Counter(b for _, f in own for b in f)
    s_all, t_all = sum(have.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + buckets) / ((have[b] + 1) * (t_all + buckets)))) for b in have}
    out = []
    for (i, _), (words, f) in zip(rows, own, strict=True):
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:len(able) * percent // 100]):
        r[4] = k + 1
    return out


@pytest.mark.parametrize(("longest", "percent"), [(1, 10), (3, 60)])
def test_resampling(spark, docs, none, longest, percent):  # noqa: F811
    target = ["w1 w2 w3 W4 w5", None, "", "don't é漢", "w7 " * 40]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(docs, goal, percent=percent, longest=longest, buckets=500).collect()
    want = resampled_plain(plain(docs), target, percent, 20, longest, 500)
    assert Counter(tuple(r)[:4] for r in got) == Counter(tuple(r[:4]) for r in want)
    assert Counter((r["doc_id"], r["score"], r["rank"]) for r in got if r["rank"]) == Counter((r[0], r[3], r[4]) for r in want if r[4])
    assert importance.resample(none, goal).count() == 0
    assert importance.resample(docs, goal.limit(0)).count() == docs.count()


def test_long_text_is_one_document():
    words, doc, bucket = importance.batch_features(["a b", "b " * 50_000, None, "c"], 2, 97)
    assert words.tolist() == [2, 50_000, 0, 1] and np.bincount(doc).tolist() == [3, 99_999, 0, 1]


def test_sets_move_once(spark, monkeypatch):
    """Sets go from the text to where they are compared: none is written, and one exchange each brings the two sides together."""
    labels, plans, plain_written = [], [], minhash.written

    def told(df, label):
        labels.append(label)
        plans.append((label, df._jdf.queryExecution().optimizedPlan().toString()))
        return plain_written(df, label)

    monkeypatch.setattr(minhash, "written", told)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[: 60 - i % 4] + [f"x{i}"])) for i in range(30)] + [(1, " ".join(words)), (1, " ".join(words)), (None, " ".join(words)), (None, " ".join(words))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, minhash.near_copies(df).collect())) == linked_plain(rows)
    assert "star-links" in labels and not any("elements" in p for label, p in plans if label != "star-links")
    # aggregates over sets: the one that drops repeated left sides
    assert all(p.count("first(elements") + p.count("first(x") <= 1 for label, p in plans if label == "star-links")
