"""Phrases, byte dedup by suffix order, and the conversation trie, against brute force and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from strata.llm import phrases, prefix_trie, suffix_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def best_phrases(rows, least=10, share=50, top=2000):
    count, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i : i + k])] += 1
    out = collections.defaultdict(list)
    candidates = {x: n for x, n in count.items() if len(x[1]) > 1 and n >= least}
    longest = collections.Counter()
    for (lang, words), n in candidates.items():
        if len(words) == 3:
            for part in (words[:2], words[1:]):
                longest[lang, part] = max(longest[lang, part], n)
    for (lang, words), a in candidates.items():
        if 100 * longest[lang, words] >= share * a and len(words) == 2:
            continue
        cuts = [(10**6 * a * a // (count[lang, words[:k]] * count[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(words).encode(), count[lang, words[:k]], count[lang, words[k:]]))
    return {(lang, i + 1, p.decode(), -a, x, y, total[lang], -s)
            for lang, own in out.items() for i, (s, a, p, x, y) in enumerate(sorted(own)[:top])}


def found_phrases(df, **more):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in phrases.collocations(df, **more).collect()}


@pytest.mark.parametrize("bucket_bytes", [12 << 20, 40])
def test_phrases_match_brute_force(spark, monkeypatch, bucket_bytes):
    """Small buckets make the common pairs frequent ones, routed by three words."""
    monkeypatch.setattr(phrases, "BUCKET_BYTES", bucket_bytes)
    monkeypatch.setattr(phrases, "_CHUNK", 2000)
    rng = random.Random(3)
    words = ["a", "B", "b", "of", "the", "é", "中文", "x1", "ß"]
    rows = [("".join(rng.choice(words) + rng.choice([" ", " ", "\t", " ", ". ", "\n", ", "]) for _ in range(rng.randint(0, 120))),
             rng.choice(["en", "en", None, "de"])) for _ in range(80)]
    rows += [("hot pair " + rng.choice(words) + " tail", "en") for _ in range(100)] + [(None, "en"), ("", "fr"), ("one", "it")]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    want = best_phrases(rows)
    assert found_phrases(df) == want and any(len(p[2].split()) == 3 for p in want)
    assert found_phrases(df, top=3, least=5) == best_phrases(rows, least=5, top=3)


def test_phrases_draw_hashes_anew(spark, monkeypatch):
    """Two words with one hash: the words are named anew."""
    real = phrases._ids
    monkeypatch.setattr(phrases, "_ids", lambda w, langs, draw: np.ones(len(w.starts), np.uint64) if draw == 0 else real(w, langs, draw))
    rows = [("one two three", "en")] * 12
    assert found_phrases(spark.createDataFrame(rows, "text string, lang string")) == best_phrases(rows)


def test_phrases_awkward(spark, awkward, nothing):
    rows = [(r.text, r.lang) for r in awkward.collect()]
    assert found_phrases(awkward) == best_phrases(rows)
    assert phrases.collocations(nothing).count() == 0


def test_equal_partitions_count_prefixes():
    rng = np.random.default_rng(0)
    keys = [rng.integers(1, 6, 5000).astype(np.uint64) for _ in range(3)]
    keys[2][rng.random(5000) < 0.2] = 0
    weight = rng.integers(1, 4, 5000)
    pairs, triples = collections.Counter(), collections.Counter()
    for a, b, c, w in zip(*(k.tolist() for k in keys), weight.tolist()):
        pairs[a, b] += w
        if c:
            triples[a, b, c] += w
    two, three = phrases.equal_partitions(keys, weight, 60)
    assert {(int(keys[0][i]), int(keys[1][i])): int(n) for i, n in zip(*two)} == {k: n for k, n in pairs.items() if n >= 60}
    assert {tuple(int(k[i]) for k in keys): int(n) for i, n in zip(*three)} == {k: n for k, n in triples.items() if n >= 60}
    assert all(len(x) == 0 for x, _ in phrases.equal_partitions([np.zeros(0, np.uint64)] * 3, np.zeros(0, np.int64), 1))


def left_over(rows, k):
    """Bytes kept of each (id, text), by the first place of every window."""
    first = {}
    for i, t in rows:
        if i is not None:
            b = (t or "").encode()
            for p in range(len(b) - k + 1):
                w = b[p : p + k]
                first[w] = min((i, p), first.get(w, (i, p)))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - k + 1 if i is not None else 0):
            if first[b[p : p + k]] < (i, p):
                gone[p : p + k] = [True] * k
        n = sum(g and not h for g, h in zip(gone, [False, *gone]))
        out[i, t] = (len(b), sum(gone), n, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def check_bytes(df, rows, k):
    seen = suffix_dedup.dedup(df, k=k).collect()
    want = left_over(rows, k)
    assert sorted(((r.doc_id, r.text) for r in seen), key=str) == sorted(rows, key=str)
    for r in seen:
        assert (r["__n_bytes"], r["__n_removed"], r["__n_spans"], r["__kept_sha256"]) == want[r.doc_id, r.text], (r.doc_id, r.text)
    return sum(x[1] for x in want.values())


@pytest.mark.parametrize("k", [1, 7, 30, 100])
@pytest.mark.parametrize("small", [False, True])
def test_suffix_dedup_matches_brute_force(spark, monkeypatch, k, small):
    """Small limits: several buckets, batches, pieces of a long text, and frequent minimisers of both kinds."""
    if small:
        monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 300)
        monkeypatch.setattr(suffix_dedup, "BATCH", 500)
        monkeypatch.setattr(suffix_dedup, "_CHUNK", 1500)
    rng = random.Random(k)
    passage = "".join(rng.choice("abcdeé 中") for _ in range(160))
    rows = []
    for i in range(50):
        t = "".join(rng.choice("abcdefgh éß\n") for _ in range(rng.randint(0, 300)))
        kind = i % 6
        if kind == 1:
            t = t[:50] + passage[rng.randint(0, 30) :] + t[50:]
        elif kind == 2 and rows:
            t = rows[-1][1]
        elif kind == 3:
            t = t[:30] * 9
        elif kind == 4:
            t = "x" * rng.randint(0, 400)
        rows.append((i * 7 % 50, t))
    rows += [(7, "ab" * 2500), (None, passage), (60, None), (61, ""), (60, rows[1][1]), (7, "ab" * 2500), (2**40, passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert check_bytes(df, rows, k)


def test_suffix_dedup_awkward(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    seen = {(r.doc_id, r.text): r for r in suffix_dedup.dedup(awkward).collect()}
    want = left_over(rows, 100)
    for key, r in seen.items():
        assert (r["__n_bytes"], r["__n_removed"], r["__n_spans"], r["__kept_sha256"]) == want[key] and r.key == "x"
    assert suffix_dedup.digests(nothing).count() == 0
    assert suffix_dedup.dedup(awkward.withColumnRenamed("key", "__key")).columns == [c for c in suffix_dedup.dedup(awkward).columns if c != "key"]


def test_transform_matches_sorted_suffixes():
    rng = random.Random(1)
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 14))) for _ in range(rng.randint(1, 12))]
        length = np.array([len(t) for t in texts])
        bwt, lcp = suffix_dedup.insert_columns(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(length) - length, length, 5)
        order = sorted(([c + 1 for c in t[i:]] + [0], j, i) for j, t in enumerate(texts) for i in range(len(t) + 1))
        assert bwt.tolist() == [texts[j][i - 1] + 1 if i else 0 for _, j, i in order]
        common = [0]
        for (a, *_), (b, *_) in zip(order, order[1:]):
            n = 0
            while n < min(len(a), len(b)) - 1 and a[n] == b[n]:
                n += 1
            common.append(min(n, 5))
        assert lcp.tolist() == common


def trie_by_hand(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(node[:-1] for node in members if node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, own_members in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own_members) - 1) * len(node[-1][1]) if node else 0
    return {(min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node], leaves[node], saved[node],
             hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(node)))).encode()).hexdigest())
            for node, m in members.items()}


TURNS = "conv_id long, turn long, role string, text string"


def found_nodes(df):
    rows = prefix_trie.trie(df).collect()
    found = {(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


def test_trie_matches_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 260, 3), 1000, 1001, 1099, 2**40 + 7]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 8, 9, 16, 17])):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["a", "é中", "", "🙂🙂"]) if t % 2 else "same"))
    rows += [(300, t, "user", f"turn {t}") for t in range(133)] + [(305, t, "user", f"turn {t}") for t in range(133)]
    df = spark.createDataFrame(rows, TURNS).repartition(7)
    assert found_nodes(df) == trie_by_hand(rows)


def test_trie_awkward(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, None), (1, None, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 5, "", ""),
            (2, None, "user", "b"), (100, 0, "us", "er"), (101, 0, "use", "r"), (102, 1, "user", "word " * 30_000), (103, 1, None, "z")]
    df = spark.createDataFrame(rows, TURNS)
    for name in ("depth", "owner", "n", "conv", "pos"):
        df = df.selectExpr("*", f"'x' as {name}")
    assert found_nodes(df) == trie_by_hand(rows)
    assert prefix_trie.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame(rows[:1], TURNS)).count() == 0
    # nobody has a turn left: the root alone
    alone = [(101, 0, "user", "x")]
    assert zlib.crc32(b"101") % 6 > 0 and found_nodes(spark.createDataFrame(alone, TURNS)) == trie_by_hand(alone)
