"""Word hashes, n-gram join, substring dedup, fingerprints and mixing against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridpanel.llm import fingerprint, mixing, ngram_join, substrings
from gridpanel.llm import words as W
from gridpanel.llm.common import components

WORD = re.compile("[^\x20\x09-\x0D]+")


def words(text, lower=False):
    text = text or ""
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text) if lower else text)


@pytest.fixture(scope="module")
def texts():
    """Random texts with copies, near copies, shared passages, and the awkward ones."""
    rnd = random.Random(5)
    vocabulary = ["w%d" % i for i in range(300)] + ["É", "The", "the"]
    passage = [rnd.choice(vocabulary) for _ in range(14)]
    out = []
    for i in range(60):
        own = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        if i % 7 == 3:
            own[len(own) // 2:len(own) // 2] = passage
        if i % 5 == 4:
            own = words(out[rnd.randrange(len(out))][1])
            for _ in range(rnd.choice([0, 0, 1, 2, 6])):
                if own:
                    own[rnd.randrange(len(own))] = rnd.choice(vocabulary)
        out.append((i * 3, rnd.choice([" ", "\n", "  ", "\t"]).join(own)))
    long = " ".join(rnd.choice(vocabulary) for _ in range(20_000))
    return [*out, (500, None), (501, ""), (502, " \n\t"), (503, "one"), (504, "ONE"), (505, long), (506, long + " more"), (506, long + " more"), (None, "no id here at all")]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", 7) for i, t in texts], "doc_id long, text string, `text 2` string, n_words int")


def test_words(texts, monkeypatch):
    for size in (W.CHUNK, 37):
        monkeypatch.setattr(W, "CHUNK", size)
        hashes, starts, data, begins, ends = W.hashed_words(pa.array([t for _, t in texts]), spans=True)
        seen = {}
        for i, (_, text) in enumerate(texts):
            own = words(text)
            assert starts[i + 1] - starts[i] == len(own)
            for w, h, a, b in zip(own, hashes[starts[i]:starts[i + 1]], begins[starts[i]:starts[i + 1]], ends[starts[i]:starts[i + 1]]):
                assert bytes(data[a:b]).decode() == w and seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)
    assert len(W.hashed_words(pa.array([], pa.string()))[0]) == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (10, 9), (9, 8), (8, 8), (20, 21), (21, 20), (None, 1)] + [(i, i + 1) for i in range(100, 140)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {k: found[k] for k in (1, 5, 8, 10, 21, 100, 140)} == {1: 1, 5: 1, 8: 8, 10: 8, 21: 20, 100: 100, 140: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def groups_of(texts, size, num, den):
    sets = []
    for i, t in texts:
        own = words(t, True)
        k = min(size, len(own))
        sets.append((i, {tuple(own[j:j + k]) for j in range(len(own) - k + 1)} if own else set()))
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and den * len(x & y) >= num * len(x | y):
                old, new = label[a], label[b]
                label = [new if v == old else v for v in label]
    least = {}
    for (i, _), v in zip(sets, label):
        least[v] = min((x for x in (i, least.get(v)) if x is not None), default=None)
    return sorted(((i, len(s), least[v]) for (i, s), v in zip(sets, label)), key=str)


@pytest.mark.parametrize("size,num,block", [(4, 85, 20_000), (2, 60, 3)])
def test_ngram_join(spark, texts, monkeypatch, size, num, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    got = ngram_join.jaccard_groups(frame(spark, texts), size, num, 100)
    assert sorted(map(tuple, got.collect()), key=str) == groups_of(texts, size, num, 100)


def test_rows_without_an_id_link_like_others(spark):
    """A null id whose set is near, not equal, to another's is in that one's group; among themselves they have none."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text), (None, text + " more"), (None, "quite " + text + " more"), (None, "alone in the world"), (8, "quite " + text + " more or")]
    got = ngram_join.jaccard_groups(frame(spark, rows), 4, 85, 100).collect()
    assert sorted([tuple(r) for r in got], key=str) == sorted(
        [(5, 57, 5), (None, 58, 5), (None, 59, 5), (None, 1, None), (8, 60, 5)], key=str)


def test_first_of_groups_judges_each_row_by_its_text(spark):
    """Of rows that share an id only the one that copies an earlier document goes."""
    a, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"clean{i}" for i in range(50))
    rows = [(1, a), (2, a + " more"), (2, other), (2, other), (3, other + " more"), (4, ""), (4, None), (4, ""), (None, a), (5, "short text")]
    kept = ngram_join.first_of_groups(frame(spark, rows), 4, 85, 100).select("doc_id", "text").collect()
    assert sorted([tuple(r) for r in kept], key=str) == sorted([(1, a), (2, other), (4, ""), (4, None), (None, a), (5, "short text")], key=str)


def test_first_of_groups(spark, texts):
    kept = ngram_join.first_of_groups(frame(spark, texts), 4, 85, 100)
    assert kept.columns == ["doc_id", "text", "text 2", "n_words"]
    want = sorted({i for i, _, c in groups_of(texts, 4, 85, 100) if i == c and i is not None}) + [None]
    assert sorted((r[0] for r in kept.collect()), key=lambda x: (x is None, x)) == want
    assert ngram_join.first_of_groups(frame(spark, texts).limit(0)).count() == 0


def cut_of(texts, size):
    first = {}
    for i, t in texts:
        own = words(t)
        for j in range(len(own) - size + 1):
            if i is not None:
                key = tuple(own[j:j + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in texts:
        own = words(t)
        gone = set()
        for j in range(len(own) - size + 1):
            if i is not None and first[tuple(own[j:j + size])] < i:
                gone.update(range(j, j + size))
        out.append((i, " ".join(w for j, w in enumerate(own) if j not in gone), len(own), len(gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits,sparse", [(24, 16), (6, 0)])
def test_substrings(spark, texts, monkeypatch, bits, sparse):
    monkeypatch.setattr(substrings, "CELL_BITS", bits)  # a narrow sketch gives false alarms only
    monkeypatch.setattr(substrings, "SPARSE", sparse)
    got = substrings.remove_repeats(frame(spark, texts), 10)
    assert got.columns == ["doc_id", "text", "text 2", "n_words", "n_removed"]
    assert sorted(((r[0], r[1], r[3], r[4]) for r in got.collect()), key=str) == cut_of(texts, 10)


def test_substrings_keep_untouched(spark, texts):
    got = {(r[0], r[4] > 0): r[1] for r in substrings.remove_repeats(frame(spark, texts), 10, keep_untouched=True).collect()}
    assert got[500, False] is None and got[502, False] == " \n\t" and any(k[1] for k in got)
    assert substrings.remove_repeats(frame(spark, texts).limit(0), 10).count() == 0


def test_packed_cells():
    for n in (0, 1, 511, 512, 5000):
        cells = np.sort(np.random.default_rng(n).integers(0, 1 << 24, n))
        assert (substrings.unpack(substrings.pack(cells)) == cells).all()


def jaccard(a, b):
    a, b = Counter(a), Counter(b)
    both = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in both) / sum(max(a[k], b[k]) for k in both) if both else 1.0


def test_fingerprints(spark, texts):
    own = [x for x in texts if x[0] is not None]
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(frame(spark, own)).collect()}
    order = sorted({i: t or "" for i, t in own}.items(), reverse=True)
    edited_off, next_off, same = [], [], {}
    for place, (i, t) in enumerate(order):
        after = order[(place + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r["fingerprint"]) == (8 * fingerprint.SAMPLES if words(t) else 0)
        assert same.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        edited_off.append(r["near_edited"] - jaccard(words(t), words(edited)))
        next_off.append(r["near_next"] - jaccard(words(t), words(after)))
    assert abs(np.mean(edited_off)) < 0.05 and np.sqrt(np.mean(np.square(edited_off))) < 0.15 and abs(np.mean(next_off)) < 0.05
    assert fingerprint.fingerprints(frame(spark, texts)).count() == len(texts)
    assert fingerprint.fingerprints(frame(spark, texts).limit(0)).count() == 0
    assert fingerprint.fingerprints(frame(spark, [(1, "a b")])).first()["near_next"] == 1.0


def shares(total, nodes):
    """(name, weight, capacity) to tokens, by raising the level until the budget is used."""
    out, rest, left = {}, total, [n for n in nodes if n[1] > 0]
    while left:
        level = rest / sum(n[1] for n in left)
        full = [n for n in left if n[2] <= level * n[1]]
        if not full:
            return out | {n[0]: int(level * n[1]) for n in left}
        for n in full:
            out[n[0]] = n[2]
            rest -= n[2]
        left = [n for n in left if n not in full]
    return out


@pytest.mark.parametrize("share,epochs", [(0.5, 2), (1.7, 3), (9.0, 1)])
def test_mixing(spark, share, epochs):
    rnd = random.Random(int(share * 10))
    docs = [(i, " ".join(["w"] * rnd.randint(0, 30)), rnd.choice(["a", "a", "b", None]), rnd.choice(["x", "y", "z"])) for i in range(400)]
    docs += [docs[5], (None, "w w", "a", "x"), (900, None, "b", "y")]
    df = spark.createDataFrame([(*d, 1, "y") for d in docs], "doc_id long, text string, lang string, source string, epoch int, full string")
    weights = {"lang": {"a": 3, "b": 1, "(none)": 1}, "source": {"x": 2, "z": 0}}
    got = mixing.mix(df, {"lang": "lang", "source": "source"}, weights, share, epochs, 3)
    assert got.columns == ["doc_id", "text", "lang", "source", "full", "epoch", "tokens"]
    rows = got.collect()
    tokens = Counter()
    for _, t, lang, source in docs:
        tokens[lang or "(none)", source] += len(words(t))
    total = int(share * sum(tokens.values()))
    capacity = {l: sum(v * epochs for (a, s), v in tokens.items() if a == l and s != "z") for l in ("a", "b", "(none)")}  # z weighs 0
    top = shares(min(total, sum(capacity.values())), [(l, weights["lang"][l], capacity[l]) for l in capacity])
    taken = Counter()
    for r in rows:
        taken[r["lang"] or "(none)", r["source"]] += r["tokens"]
    for lang in capacity:
        leaf = shares(top[lang], [(s, weights["source"].get(s, 1), tokens[lang, s] * epochs) for s in ("x", "y", "z") if (lang, s) in tokens])
        for s, budget in leaf.items():
            assert budget - 60 < taken[lang, s] <= budget
        assert taken[lang, "z"] == 0
    assert max((r["epoch"] for r in rows), default=0) < epochs
    assert sorted(map(tuple, mixing.mix(df, {"lang": "lang", "source": "source"}, weights, share, epochs, 3).collect()), key=str) == sorted(map(tuple, rows), key=str)


def test_mixing_gives_no_tokens_to_branches_without_weight(spark):
    """What lies below a weight of 0 is no capacity of its ancestors: their shortage goes to the siblings."""
    docs = [(i, "w", "d0", "en" if i < 90 else "fr") for i in range(100)] + [(100 + i, "w w w w w w w w w w", "d1", "fr") for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string, domain string, lang string")
    got = mixing.mix(df, {"domain": "domain", "lang": "lang"}, {"lang": {"en": 0}}, 1000, 1)
    assert {r["domain"]: r["n"] for r in got.groupBy("domain").agg(F.sum("tokens").alias("n")).collect()} == {"d0": 10, "d1": 990}
    everything = mixing.mix(df, {"domain": "domain", "lang": "lang"}, {"lang": {"en": 0}}, 5000, 1)
    assert everything.agg(F.sum("tokens")).first()[0] == 1010


def test_mixing_edges(spark):
    df = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    assert mixing.mix(df.limit(0), {"source": "source"}, {}, 0.5).count() == 0
    assert mixing.mix(df, {"source": "source"}, {}, 0).count() == 0
    assert mixing.mix(df, {"source": "source"}, {}, 5, 2).select("epoch").count() == 2
    assert mixing.mix(df, {"source": F.lit(None)}, {"source": {"(none)": 0}}, 5).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(df, {"source": "source"}, {}, 5, 0)
