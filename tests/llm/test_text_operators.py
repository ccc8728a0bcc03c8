"""Operators over documents, against brute force and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate, jaccard, language, license_scan, ngram_model, packing, substrings, tokens, toxicity, words
from strata.llm.components import components

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CONTRACT = {
    "op1": (substrings.digests, {"doc_id", "n_words", "n_removed", "kept_sha256"}),
    "op2": (language.predictions, {"doc_id", "held_out", "lang_pred", "score"}),
    "op4": (license_scan.scan, {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"}),
    "op7": (ngram_model.scores, {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"}),
    "op8": (jaccard.join, {"doc_id", "class_id", "n_links"}),
}


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("name", CONTRACT)
def test_one_row_per_document(name, awkward, nothing):
    run, columns = CONTRACT[name]
    rows = run(awkward).collect()
    assert columns <= set(rows[0].asDict())
    assert sorted((r.doc_id for r in rows), key=str) == sorted((r.doc_id for r in awkward.collect()), key=str)
    assert run(nothing).count() == 0


def test_substrings_match_brute_force(corpus):
    docs, rows = corpus
    first = {}
    for i, t, *_ in sorted(rows):
        words = SPACED.findall(t)
        for k in range(len(words) - 12):
            first.setdefault(tuple(words[k : k + 13]), i)
    found = by_id(substrings.digests(docs))
    removed = 0
    for i, t, *_ in rows:
        words = SPACED.findall(t)
        gone = [False] * len(words)
        for k in range(len(words) - 12):
            if first[tuple(words[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        assert (found[i].n_words, found[i].n_removed, found[i].kept_sha256) == (
            len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
        removed += sum(gone)
    assert removed


def test_substrings_awkward(awkward):
    found = by_id(substrings.digests(awkward))
    assert found[2**40].n_removed == 0 and found[2**40 + 1].n_removed == 14
    assert found[4].n_removed == 0 and found[7].n_words == 30_000 and found[None].n_removed == 0


def test_windows_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(words.Words, "hashes",
                        lambda self, lower=False: np.zeros(len(self.starts), np.uint64))
    strings = b"a b c d\nx y z d\na b c d"
    owner, nth = substrings._repeats(np.array([1, 2, 3]), strings, 3)
    assert list(zip(owner.tolist(), nth.tolist())) == [(2, 0), (2, 1)]


def test_language_learns_and_ignores_labels(spark):
    rows = [(i, ("the cat and the dog are here " if i % 2 else "der hund und die katze sind hier ") * (i % 5 + 1), "en" if i % 2 else "de")
            for i in range(60)]
    found = by_id(language.predictions(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    assert all(found[i].lang_pred == lang for i, _, lang in rows)
    assert {i for i in found if found[i].held_out} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}


def test_language_awkward(awkward):
    found = by_id(language.predictions(awkward))
    assert [found[i].lang_pred for i in (1, 2, 3, 5)] == ["und"] * 4 and found[1].score == 0.0
    assert 0 <= found[6].score <= 1 and found[6].lang_pred in ("en", "de")
    assert found[None].held_out is False


def test_language_features_against_direct_count():
    texts = ["Ab c\n", "", "ß1É"]
    numbers, bounds, letter = language.features([t.encode() for t in texts])
    assert letter.tolist() == [True, False, True] and bounds[1] == bounds[2]
    same, _, _ = language.features(["aB-c ".encode()])
    assert same.tolist() == numbers[: bounds[1]].tolist()


def brute_decontamination(rows, items, window=13):
    windows = collections.defaultdict(set)
    for name, text in items:
        words = plain(text)
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[k : k + window])].add(str(name))
    sizes = {len(w) for w in windows}
    out = {}
    for i, t, *_ in rows:
        words, names = plain(t), []
        hit = [False] * len(words)
        seen = set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if found := windows.get(tuple(words[k : k + size])):
                    seen |= found
                    hit[k : k + size] = [True] * size
        names = sorted(seen)
        out[i] = (len(words), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                  sum(hit) > 0 and 20 * sum(hit) >= len(words))
    return out


@pytest.mark.parametrize("shard_words", [10, 10**6])
def test_decontamination_matches_brute_force(spark, corpus, shard_words, monkeypatch):
    docs, rows = corpus
    texts = [t for _, t, *_ in rows if len(t.split()) > 40]
    items = [(1, texts[0][:200].upper()), (2, " ".join(texts[1].split()[5:40])), (3, "ba be"), (4, ""), (5, None),
             (10, " ".join(texts[2].split()[3:16])), (11, " ".join(texts[2].split()[3:15])), (12, "ba be")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate.hit_spans, "__kwdefaults__",
                        decontaminate.hit_spans.__kwdefaults__ | {"shard_words": shard_words})
    found = by_id(decontaminate.contamination(docs, benchmark))
    for i, want in brute_decontamination(rows, items).items():
        r = found[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == want


def test_automaton_matching_lengths_on_random_words():
    rng = random.Random(3)
    for _ in range(60):
        items = [(str(i), [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 9))]) for i in range(5)]
        doc = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(40)]
        k = rng.randint(2, 5)
        spans, names = decontaminate.Automaton([x for x in items if x[1]], k).hits(doc)
        hit, seen = [False] * 40, set()
        for n, (_, words) in enumerate([x for x in items if x[1]]):
            size = min(k, len(words))
            for w in ([words[j : j + size] for j in range(len(words) - size + 1)]):
                for j in range(40 - size + 1):
                    if doc[j : j + size] == w:
                        seen.add(n)
                        hit[j : j + size] = [True] * size
        assert names == seen
        assert [any(s <= j < e for s, e in spans) for j in range(40)] == hit


def test_long_items_are_cut_into_pieces(spark):
    """An item far longer than a piece, in many shards read in several blocks: the hits of one automaton over all."""
    rng = random.Random(8)
    item = [f"w{rng.randrange(400)}" for _ in range(700)]
    items = [("long", " ".join(item)), ("short", "w1 zz w2"), ("long", "yy " * 20), (None, "xx " * 15), ("none", None)]
    rows = [(0, " ".join(item)), (1, " ".join(item[300:330] + ["v"] + item[301:312])), (2, "a w1 zz w2 b"), (3, "yy " * 13), (4, "xx " * 13), (5, None)]
    rows += [(10 + at, " ".join(["v", *item[at : at + 13], "v"])) for at in range(0, 687, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")

    def spans(shard_words):
        found = decontaminate.hit_spans(docs, bench, shard_words=shard_words).collect()
        return {r.doc_id: (r["__n_words"], r["__spans"], sorted(map(str, r["__items"]))) for r in found}

    whole = spans(10**6)
    assert whole[0] == (700, [0, 700], ["long"]) and whole[1][1:] == ([0, 30], ["long"]) and whole[2][1:] == ([1, 4], ["short"])
    assert whole[3][2] == ["long"] and whole[4][2] == ["None"] and whole[5] == (0, [], [])
    assert all(whole[10 + at] == (15, [1, 14], ["long"]) for at in range(0, 687, 7))
    assert spans(300) == whole


def test_decontamination_awkward(spark, awkward, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(awkward, none).where("n_hit > 0").count() == 0
    items = spark.createDataFrame([(1, "one two three"), (None, "x y")], "item_id long, text string")
    found = decontaminate.contamination(awkward, items).where("contaminated").collect()
    assert [r.doc_id for r in found] == [4, 4]
    assert decontaminate.contamination(nothing, items).count() == 0


def test_remove_contaminated_cuts_small_hits(spark):
    words = [f"w{i}" for i in range(400)]
    docs = spark.createDataFrame([(1, " ".join(words), "en", "s", 0), (2, " ".join(words[50:63]), "en", "s", 0), (3, "All  clean", "en", "s", 7)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    items = spark.createDataFrame([(1, " ".join(words[50:63]))], "item_id long, text string")
    kept = by_id(decontaminate.remove_contaminated(docs, items))
    assert set(kept) == {1, 3} and kept[3].text == "All  clean" and kept[3].n_chars == 7
    assert kept[1].text == " ".join(words[:50] + words[63:]) and kept[1].n_chars == len(kept[1].text)


def test_license_base_and_rules(spark):
    texts = ["Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0 and cc by", "x GNU  General\nPublic LICENSE mit license", "accept", "3-clause BSD"]
    found = [r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert [r.n_base for r in found] == [1, 2, 2, 0, 0]
    assert [(r.first_word, r.last_word) for r in found] == [(3, 3), (0, 6), (1, 5), (None, None), (None, None)]
    assert found[1].labels == "cc-by,cc-by-nc-4.0" and found[2].base_labels == "gpl,mit" and found[4].labels == "bsd-3-clause"
    # the grant contains the name: one detection is left
    assert [d.label for d in found[0].detections] == ["apache-2.0"] and found[0].score == 1.0


def test_license_labels_carry_versions(spark):
    want = {
        "GPL v2": "gpl-2.0", "GPL 2.0": "gpl-2.0", "GNU GPL, version 3 or later": "gpl-3.0-or-later", "GPLv3": "gpl-3.0",
        "under the LGPL v2.1": "lgpl-2.1", "LGPL 2": "lgpl-2.0", "MPL 1.1": "mpl-1.1", "MPL 1": "mpl-1.0", "MPL 1.2": "mpl",
        "GNU General Public License v3.0": "gpl,gpl-3.0", "Apache License 2": "apache,apache-2.0", "CC BY 4.0": "cc-by,cc-by-4.0",
        "CC BY 1.0": "cc-by,cc-by-1.0", "Creative Commons Attribution License 3.0": "cc-by-3.0", "CC BY-SA": "cc-by,cc-by-sa",
        "released under the terms of the AGPL version 3 or (at your option) any later version": "agpl-3.0-or-later", "Artistic License": "artistic",
        "either version 2 of the License, or (at your option) any later version": "gnu-2.0-or-later",
        "Neither the name of the Foo Company nor the names of its contributors may be used to endorse or promote products": "bsd-3-clause",
    }
    found = license_scan.scan(spark.createDataFrame(list(enumerate(want)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert {text: r.labels for text, r in zip(want, found)} == want


def test_every_rule_passes_the_prefilter_and_matches(spark):
    """One spelling of each rule: alternatives resolved to the first, options left out."""
    def spell(pattern):
        while m := re.search(r"\(\?:([^()]*)\)(\??)|([^ (])\?", pattern):
            new = "" if m.group(3) or m.group(2) else m.group(1).split("|")[0]
            pattern = pattern[: m.start()] + new + pattern[m.end() :]
        pattern = re.sub(r"\{[\d,]+\}\??", "", pattern)
        return pattern.split("|")[0].replace("[sc]", "s").replace("[0-9]{2}", "01").replace("[0-9]", "01").replace("[^ ]+", "x")
    rules = license_scan.rules()
    assert len(rules) >= 300
    texts = [spell(r["pattern"]) for r in rules]
    found = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).where("labels = ''").collect()
    assert [(texts[r.doc_id], rules[r.doc_id]["pattern"]) for r in found] == []


def test_license_plan_is_native(awkward):
    plan = license_scan.scan(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_toxicity_finds_marked_words_and_handles_awkward_rows(spark, awkward, nothing):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(300):
        words = [f"w{rng.randrange(200)}" + rng.choice("abc") for _ in range(30)]
        words = [re.sub(r"\d", lambda m: "ghijklmnop"[int(m.group())], w) for w in words]
        bad = i % 6 == 0
        rows.append((i, " ".join(words + ["Vile!"] * bad), "en", "s", 0))
        labels.append((i, 0, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(labels + [(None, 0, 1), (2, 0, None)], "doc_id long, quality int, toxic int")
    found = by_id(toxicity.scores(docs, labels))
    assert all(found[i].predicted == int(i % 6 == 0) for i in range(300))
    kept = toxicity.remove_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in range(300) if i % 6}
    odd = toxicity.scores(awkward, labels.where("doc_id < 5"))
    assert odd.count() == 11 and all(0 <= r.score <= 1 for r in odd.collect())
    assert all(r.score == 0 for r in toxicity.scores(awkward, labels.limit(0)).collect())
    assert toxicity.scores(nothing, labels).count() == 0


def test_block_max_search_is_exact(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    rng = random.Random(2)
    terms = [f"t{i}" for i in range(40)]
    weights = np.array([rng.uniform(1, 3) * (9 if i < 5 else 1) for i in range(40)])

    def counts(n):
        ids = np.array(sorted(rng.sample(range(40), n)), np.int64)
        return ids, np.array([rng.randint(1, 4) for _ in ids], np.int64)

    examples = [(i, *counts(rng.randint(0, 5)), rng.randint(0, 1)) for i in range(900)]
    index = toxicity.Index(terms, weights, examples)
    assert index.blocks > 3
    by_key = {e[0]: e for e in examples}

    def dense(ids, n):
        out = np.zeros(40)
        out[ids] = (1 + np.log(n)) * weights[ids]
        return out / (np.linalg.norm(out) or 1)

    entries = np.array([dense(*by_key[k][1:3]) for k in index.first])
    for _ in range(60):
        ids, n = counts(rng.randint(1, 6))
        cosines = entries @ dense(ids, n)
        near = index.nearest(ids, index.unit(ids, n))
        order = np.lexsort((np.arange(len(cosines)), -cosines.round(12)))
        assert np.allclose([s for s, _ in near], cosines[order[: len(near)]])
        assert sum(index.n[i] for _, i in near) >= toxicity.NEAREST
    assert index.score("nothing known") == (index.empty, [])


def test_toxicity_scores_match_brute_force(spark):
    """Vectors over all words of two examples, frequencies over all documents, votes of the nearest."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(150)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(3, 30))) + (" moron" if i % 5 == 3 else "")) for i in range(400)]
    labels = [(i, int(i % 5 == 3)) for i in range(250)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_id(toxicity.scores(docs, spark.createDataFrame(labels, "doc_id long, toxic int")))
    bags = {i: collections.Counter(toxicity.words_of(t)) for i, t in rows}
    taught = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5]
    df, ex = collections.Counter(), collections.Counter()
    for b in bags.values():
        df.update(b.keys())
    for i, _ in taught:
        ex.update(bags[i].keys())
    n, toxic = len(taught), sum(y for _, y in taught)
    in_toxic = collections.Counter(w for i, y in taught if y for w in bags[i])

    def g(w):
        a, b = in_toxic[w], ex[w] - in_toxic[w]
        cells = [(a, ex[w] / n * toxic), (b, ex[w] / n * (n - toxic)), (toxic - a, (1 - ex[w] / n) * toxic),
                 (n - toxic - b, (1 - ex[w] / n) * (n - toxic))]
        return 2 * sum(x * math.log(x / e) for x, e in cells if x > 0)

    tells = {w for w in ex if ex[w] >= 2 and math.erfc(math.sqrt(g(w) / 2)) * len(ex) < 0.05}
    assert "moron" in tells
    weight = {w: math.log(401 / (1 + df[w])) * (toxicity.TELLING if w in tells else 1) for w in ex
              if ex[w] >= 2 and (w in tells or df[w] <= toxicity.COMMON * 400)}

    def unit(i):
        v = {w: (1 + math.log(c)) * weight[w] for w, c in bags[i].items() if w in weight}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if v else {}

    vectors = {i: unit(i) for i in bags}
    base = (toxic + 0.5) / (n + 1)
    for i, r in found.items():
        if not vectors[i]:
            continue
        cosines = sorted(((sum(x * vectors[j].get(w, 0) for w, x in vectors[i].items()), y) for j, y in taught), reverse=True)
        cosines = [c for c in cosines if c[0] > 1e-15]
        if not cosines:
            continue
        cut = cosines[min(len(cosines), toxicity.NEAREST) - 1][0]
        if len(cosines) > toxicity.NEAREST and abs(cosines[toxicity.NEAREST][0] - cut) < 1e-9:
            continue  # a tie at the cut may go either way
        near = cosines[: toxicity.NEAREST]
        votes = sum(s / near[0][0] for s, _ in near)
        want = (sum(s / near[0][0] * y for s, y in near) + base) / (votes + 1)
        assert math.isclose(r.score, want, rel_tol=1e-6), i


def test_ngram_model_matches_brute_force(corpus):
    docs, rows = corpus
    texts = {i: [*SPACED.findall(t.translate(LOWER)), None] for i, t, *_ in rows}
    train = {i: t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 5 != 1}
    count = collections.Counter(w for t in train.values() for w in t)
    pairs = collections.Counter(p for t in train.values() for p in zip(["<s>", *t], t))
    total, kinds = sum(count.values()), collections.Counter(w for _, w in pairs)

    def discounts(values):
        n = collections.Counter(values)
        return ngram_model._discounts([n[i] for i in range(1, 5)])

    d, e = discounts(pairs.values()), discounts(kinds.values())
    left = sum(e[min(v, 3)] for v in kinds.values()) / len(pairs)
    starts, spent = collections.Counter(), collections.Counter()
    for (u, _), n in pairs.items():
        starts[u] += n
        spent[u] += d[min(n, 3)]

    def q(w):
        return max(kinds[w] - e[min(kinds[w], 3)], 0) / len(pairs) + left / (len(count) + 1)

    def p(u, w):
        if u not in starts:
            return q(w)
        n = pairs[u, w]
        return max(n - d[min(n, 3)], 0) / starts[u] + spent[u] / starts[u] * q(w)

    # probabilities after any word sum to 1 over all words and one unknown
    assert math.isclose(sum(p("ba", w) for w in [*count, "unknown"]), 1)
    for i, r in by_id(ngram_model.scores(docs)).items():
        t = texts[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(w in count for w in t), total)
        assert math.isclose(r.score, sum(math.log10(p(u, w)) for u, w in zip(["<s>", *t], t)), rel_tol=1e-9)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in t), rel_tol=1e-9)


def test_jaccard_matches_brute_force(corpus):
    docs, rows = corpus
    sets = {}
    for i, t, *_ in rows:
        w = plain(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = by_id(jaccard.join(docs))
    assert {i: r.class_id for i, r in found.items()} == root
    assert {i: r.n_links for i, r in found.items()} == {i: sum(i in x for x in links) for i in sets}
    kept = jaccard.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values())) and kept.columns == docs.columns


def test_jaccard_large_group_of_near_copies(spark, monkeypatch):
    """Several tiles and levels: every member is linked to every other, none to strangers."""
    monkeypatch.setattr(jaccard, "TILE", 64)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base[:i % 200] + [f"x{i}"] + base[i % 200 + 1 :])) for i in range(300)]
    rows += [(1000 + i, " ".join(f"y{i}z{j}" for j in range(50))) for i in range(40)]
    found = by_id(jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")))
    assert all(found[i].class_id == 0 and found[i].n_links == 299 for i in range(300))
    assert all(found[1000 + i].class_id == 1000 + i and found[1000 + i].n_links == 0 for i in range(40))


def test_jaccard_awkward(awkward):
    rows = jaccard.join(awkward).collect()
    found = {r.doc_id: r for r in rows}
    assert found[None].class_id is None and found[1].class_id == 1 and found[3].n_links == 0
    assert found[2**40 + 1].class_id == 2**40 and found[4].n_links == 1
    assert jaccard.keep_one(awkward).count() == 9


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_plan_is_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(30):
        counts = {n: rng.randint(1, 30) for n in rng.sample(range(1, 65), rng.randint(1, 30))}
        plan = packing.plan(counts, 64)
        free: list[int] = []
        for n in sorted(counts, reverse=True):
            for _ in range(counts[n]):
                fitting = [f for f in free if f >= n]
                if fitting:
                    free[free.index(min(fitting))] -= n
                else:
                    free.append(64 - n)
        used: dict[int, list] = collections.defaultdict(list)
        ranks = collections.Counter()
        for length, rank, n, first, each, offset in plan:
            assert rank == ranks[length]
            ranks[length] += n
            for j in range(n):
                used[first + j // each].append((offset + j % each * length, length))
        assert dict(ranks) == counts and sorted(64 - sum(n for _, n in x) for x in used.values()) == sorted(free)
        for places in used.values():
            at = 0
            for offset, n in sorted(places):
                assert offset == at
                at += n


def test_packing_round_trip(spark, awkward, nothing):
    vocabulary = tokens.default_paths()
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(vocabulary[0])
    reference.encode_special_tokens = True
    rows = packing.pack(awkward).collect()
    texts = collections.defaultdict(list)
    for r in awkward.collect():
        texts[r.doc_id].append(reference.encode(r.text or "", add_special_tokens=False).ids + [2])
    for doc_id, want in texts.items():
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: (r.start, r.piece))
        assert sum(r.length for r in own) == sum(map(len, want))
        for r in own:
            ids = np.array(want[0][r.start : r.start + r.length], "<u4")
            assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and (r.piece == 0 or r.length == 1024)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 1024
    assert packing.pack(nothing).count() == 0


def test_encoder_agrees_with_the_vocabulary():
    encoder = tokens.Encoder(*tokens.default_paths())
    rng = random.Random(6)
    parts = [" "] * 6 + ["\n"] * 3 + ["\t", "\x0b", "\x85", "\xa0", "'", "s", "'re", "é", "ß", "1", "½", "中", "🙂", "a", "The", "ing", ".", "$", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choice(parts[: rng.choice([9, len(parts)])] + ["ab", "é", "'s"]) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # with and without words remembered
        assert [x.tolist() for x in encoder.encode([t.encode() for t in texts])] == want
    assert any(tokens.simple(t.encode()) for t in texts)


def test_held_out_toxicity_and_language_on_the_small_tables(spark):
    from strata.llm.queries import queries

    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = queries()["op2_language_id"](spark, sf).where("held_out").join(truth, "doc_id")
    assert rows.where("lang = lang_pred").count() >= 0.97 * rows.count()
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries()["op5_toxicity"](spark, sf).where("held_out").join(labels, "doc_id")
    assert rows.where(F.col("toxic") == F.col("predicted")).count() >= 0.9 * rows.count()


def test_jaccard_repeated_ids_of_different_texts(spark):
    """No link and no text is lost where one id has rows of two texts."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (1, b), (2, b + " more"), (3, a + " more")]
    found = {(r.doc_id, r.n_links) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(1, 1), (2, 1), (3, 1)}
    rows = [(1, a), (1, b), (2, b), (3, a), (3, a), (4, None), (4, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as __keep", "1 as __hash")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (1, b), (4, None), (4, "")], key=str)


def test_names_with_underscores_pass_through(spark, corpus):
    docs, _ = corpus
    odd = docs.selectExpr("*", "'x' as __n_words", "2 as __text", "3 as __id", "4 as __spans", "5 as __key")
    kept = substrings.remove_repeats(odd)
    assert kept.columns == odd.columns and {(r["__n_words"], r["__text"], r["__id"]) for r in kept.collect()} == {("x", 2, 3)}


def test_language_matches_naive_bayes_by_hand(spark):
    """Counts of the hashed runs of two and three characters, added up and scored in plain Python."""
    rng = random.Random(3)
    alphabets = {"aa": "abcde é", "bb": "cdefg ß", "cc": "xyzab 中"}
    rows = [(i, "".join(rng.choice(alphabets[lang]) for _ in range(rng.randint(0, 60))), lang)
            for i, lang in enumerate(rng.choice(sorted(alphabets)) for _ in range(120))]
    rows += [(200, "\U000F0000\U000F0001", "aa"), (201, "\U00020000\U00020001", None), (202, None, "bb"), (203, "cde", None)]

    def runs_of(text):
        codes = [ord(c.lower()[0]) if c.isalpha() else 32 for c in text or ""] + [32, 32]
        out = []
        for k in (2, 3):
            for i in range(len(codes) - 2):
                own = (codes + [32, 32])[i : i + k]
                if any(c != 32 for c in own):
                    key = own[0]
                    for c in own[1:]:
                        key = (key * 0x01000193 + c) % 2**32
                    key = (key * 0x9E3779B1 % 2**32) ^ (k * 0x05EBCA6B % 2**32)
                    key ^= key >> 15
                    out.append((key * 0x2C1B3C6D % 2**32) >> 17)
        return out

    counts, priors = collections.defaultdict(collections.Counter), collections.Counter()
    for i, t, lang in rows:
        if lang is not None and zlib.crc32(str(i).encode()) % 5:
            counts[lang].update(runs_of(t))
            priors[lang] += 1
    langs = sorted(priors)
    found = by_id(language.predictions(spark.createDataFrame(rows, "doc_id long, text string, lang string")))
    for i, t, _ in rows:
        own = runs_of(t)
        if not any(c.isalpha() for c in t or ""):
            assert (found[i].lang_pred, found[i].score) == ("und", 0.0), i
            continue
        logs = []
        for lang in langs:
            total = sum(counts[lang].values()) + language.ALPHA * language.FEATURES
            logs.append(math.log(priors[lang] / sum(priors.values())) + sum(math.log((counts[lang][f] + language.ALPHA) / total) for f in own))
        chance = 1 / sum(math.exp(x - max(logs)) for x in logs)
        assert math.isclose(found[i].score, chance, rel_tol=1e-3), i
        assert chance < 0.51 or found[i].lang_pred == langs[logs.index(max(logs))]
    assert found[201].lang_pred != "und"


def test_license_base_columns_match_brute_force(spark):
    rng = random.Random(6)
    words = [w for p in license_scan.BASE for w in p.split()] + ["x", "of", "Apache", "GPL", "the", "é", "by4"]
    rows = [(i, rng.choice(["", " ", "-"]).join([""] * 2) + "".join(rng.choice(words) + rng.choice([" ", " ", ", ", "\n", "-"])
             for _ in range(rng.randint(0, 60)))) for i in range(300)] + [(900, None), (901, "")]
    found = by_id(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    places_seen = 0
    for i, t in rows:
        own = plain(t)
        places = [(k, label) for k in range(len(own)) for phrase, label in license_scan.BASE.items()
                  if own[k : k + len(phrase.split())] == phrase.split()]
        r = found[i]
        starts = [k for k, _ in places]
        assert (r.n_words, r.n_base) == (len(own), len(places)), (i, t)
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        places_seen += len(places)
    assert places_seen > 50


def test_contamination_counts_an_item_once(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, passage), (2, "other " + passage[:40])], "doc_id long, text string")
    bench = spark.createDataFrame([("a", passage), ("a", passage), ("b", "w0 w1"), (None, passage)], "item_id string, text string")
    found = by_id(decontaminate.contamination(docs, bench))
    assert (found[1].n_hit, found[1].items_sha256) == (20, hashlib.sha256(b"a,b").hexdigest())
    assert found[2].items_sha256 == hashlib.sha256(b"b").hexdigest()
