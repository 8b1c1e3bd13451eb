"""Vector codes, quality rules and repaired conversations against plain versions."""

import hashlib
import random
import re
from array import array
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import conversations, rules, vectorcodes

SF = "/root/testdata/sf0.001"


# Vector codes


@pytest.fixture(scope="module")
def points():
    """Clusters, spread points and many equal ones, in three parts of two."""
    rng = np.random.default_rng(3)
    near = rng.integers(-4000, 4000, (3, 12, 2))[:, rng.integers(0, 12, 500)] + rng.integers(-30, 30, (3, 500, 2))
    spread = rng.integers(-(1 << 24), 1 << 24, (3, 200, 2))
    return np.concatenate([near, spread, np.repeat(near[:, :1], 150, axis=1)], axis=1).astype(np.int32)


def plain_codes(points, books):
    apart = ((points.astype(object)[:, :, None, :] - books.astype(object)[:, None]) ** 2).sum(axis=-1)
    return apart.argmin(axis=-1), apart.min(axis=-1)


def test_trees_cover_their_points(points):
    trees = vectorcodes.Trees.build(points)
    assert sorted(trees.order) == list(range(3 * points.shape[1]))
    for node in range(len(trees.start)):
        held = trees.flat[trees.order[trees.start[node] : trees.end[node]]]
        assert np.sqrt(vectorcodes.square(held, held[0])).max() <= trees.radius[node] + 1e-6
        children = range(trees.child[node], trees.last[node])
        if children:
            assert [trees.start[c] for c in children] == [trees.start[node], *(trees.end[c] for c in children[:-1])]
            assert trees.end[children[-1]] == trees.end[node]
            assert all(trees.radius[c] <= trees.radius[node] / 2 + 1e-6 for c in children)


@pytest.mark.parametrize("entries", [1, 2, 16])
def test_trees_assign_like_a_plain_search(points, entries):
    trees = vectorcodes.Trees.build(points)
    books = points[:, :entries].astype(np.int64)
    if entries == 16:
        books[:, 5] = books[:, 4]  # A tie goes to the lower entry.
    code, error = plain_codes(points, books)
    mine, mine_error = trees.codes(books)
    assert (mine.T == code).all() and (mine_error == error.sum(axis=0)).all()
    _, sums, counts = trees.assign(books)
    for part in range(3):
        for entry in range(entries):
            of = code[part] == entry
            assert counts[part, entry] == of.sum()
            assert (sums[part, entry] == points[part][of].astype(np.int64).sum(axis=0)).all()


def test_whole_subtrees_are_taken_without_a_comparison(monkeypatch):
    """Two far groups: no point is compared on its own."""
    rng = np.random.default_rng(0)
    points = (rng.integers(-50, 50, (1, 800, 4)) + np.where(np.arange(800) % 2, 9000, -9000)[None, :, None]).astype(np.int32)
    trees = vectorcodes.Trees.build(points)
    compared = []
    monkeypatch.setattr(trees, "_compare", lambda nodes, *rest: compared.append(len(nodes)))
    code, error = trees.codes(points[:, :2].astype(np.int64))
    assert sum(compared) == 0 and (code.T == plain_codes(points, points[:, :2])[0]).all()


def test_odd_lengths_and_few_rows(make):
    rows = make("vec_id:long embedding:vector", [(3, [1.0, 2.0, 3.0]), (1, [1.0]), (2, [1e30, -1e30, 0.0]), (2, [0.0, 0.0, 0.0]), (None, [9.0, 9.0, 9.0]), (7, [])])
    coded, books = vectorcodes.compress(rows, "vec_id", "embedding", [rows["vec_id"]], parts=2)
    got = {r["kept"]["vec_id"]: r for r in coded.collect()}
    assert set(got) == {2, 3, None} and coded.count() == 4
    # Filled up to four components; ids that repeat are ordered by their vectors; null ids come last.
    assert books.tolist()[0] == [[0, 0], [1 << 24, -(1 << 24)], [4096, 8192], [9 * 4096, 9 * 4096]]
    assert books.tolist()[1] == [[0, 0], [0, 0], [3 * 4096, 0], [9 * 4096, 0]]
    assert got[3]["code"] == "0202" and all(r["error"] == 0 for r in got.values())
    coded, books = vectorcodes.compress(rows.where("vec_id > 7"), "vec_id", "embedding", [rows["vec_id"]])
    assert books is None and coded.collect() == []


def test_trees_are_built_once_and_in_blocks(make, monkeypatch, spark):
    """Codes do not depend on how rows are spread over trees and tasks."""
    rng = np.random.default_rng(1)
    rows = make("vec_id:long embedding:vector", [(i, v) for i, v in enumerate(rng.standard_normal((300, 16)).round(3).tolist())])
    one, first = vectorcodes.compress(rows, "vec_id", "embedding", [rows["vec_id"]])
    many, second = vectorcodes.compress(rows.repartition(5), "vec_id", "embedding", [rows["vec_id"]])
    assert (first == second).all()
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


# Quality rules


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


ODD = ["", None, " \t\x0b\n", "a b a b a b a", "x" * 70_000, "l\nl\n\n\n l\nl\r\n", "é ß \u0085 #*$%&|<>", "a a a", "a b c a b c d a b c", "\x1c w \x1d w \x1e w \x1f w"]


@pytest.mark.parametrize("text", ODD)
def test_measures_of_odd_texts(text):
    text_ = text or ""
    assert rules.measure(rules.Words.of(text_), text_) == plain_measures(text)


def test_measures_and_verdicts_of_the_query(spark):
    """Measures against a plain version, labelled rows of a fifth of the ids against a scorer that has not seen them."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    aside = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scorer = rules.fit(docs.where(~aside), "doc_id", "text", labels.where(~aside), "doc_id", "quality")
    judged = {r["row"]["doc_id"]: r for r in rules.judge(docs, "text", scorer, keep=["doc_id"]).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(judged) == set(texts)
    for doc_id, row in judged.items():
        measures = plain_measures(texts[doc_id])
        assert tuple(row[m] for m in rules.MEASURES) == measures
        assert row["base_failed"] == (measures[0] < 50 or 100 * measures[4] > 50 * measures[0])
        assert row["kept"] == (not row["base_failed"] and row["probability"] >= 0.5)
    marks = [(r["quality"], judged[r["doc_id"]]) for r in labels.where(aside).collect()]
    clean = [j["kept"] for q, j in marks if q == 1 and not j["base_failed"]]
    junk = [j["kept"] for q, j in marks if q == 0]
    assert len(clean) > 40 and np.mean(clean) >= 0.97
    assert len(junk) > 5 and np.mean(junk) <= 0.05


def test_features_do_not_depend_on_the_stretch(monkeypatch):
    text = "Some words, é and ß, over and over. " * 40
    whole = rules.features(rules.Words.of(text))
    for size in (1, 7, 64):
        monkeypatch.setattr(rules, "STRETCH", size)
        assert np.allclose(rules.features(rules.Words.of(text)), whole)
    assert not rules.features(rules.Words.of("")).any()


def test_probabilities_are_calibrated():
    rng = np.random.default_rng(2)
    scores = rng.normal(0, 3, 20_000)
    good = rng.random(20_000) < rules.sigmoid(0.4 * scores - 0.7)
    slope, offset = rules.calibrate(scores, good)
    assert abs(slope - 0.4) < 0.03 and abs(offset + 0.7) < 0.08


def test_labels_without_a_verdict(make):
    """Null marks and ids do not count, an id that is marked both ways is left out, one kind of label teaches nothing."""
    docs = make("doc_id:long text:string", [(i, "good words here " + str(i)) for i in range(20)] + [(None, "x"), (3, "second text")])
    labels = make("doc_id:long quality:int", [(1, 1), (2, 1), (None, 0), (4, None), (5, 1), (5, 0)])
    assert rules.fit(docs, "doc_id", "text", labels, "doc_id", "quality") is rules.ACCEPT
    rows = rules.judge(docs, "text", rules.ACCEPT, limits=rules.Limits(words=2)).collect()
    assert [r["kept"] for r in rows] == [True] * 20 + [False, True]


# Conversations

SYMBOLS = range(9)


def plain_cheapest(symbols):
    """Least (cost, audit) over all prefixes, state by state: forwards, with the audits themselves."""
    fits = {1: {0: 1}, 2: {0: 2, 1: 2, 3: 2}, 3: {2: 3}}
    following = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {0: (0, "")}

    def put(into, state, cost, audit):
        if state not in into or (cost, audit) < into[state]:
            into[state] = cost, audit

    def insert(states):
        for _ in range(3):
            for state, (cost, audit) in list(states.items()):
                put(states, following[state], cost + 5, audit + "I")

    insert(best)
    for symbol in symbols:
        fresh = {}
        for state, (cost, audit) in best.items():
            put(fresh, state, cost + 2, audit + "D")
            if symbol:
                extra = 5 if symbol > 4 else 0
                put(fresh, following[state], cost + 1 + extra, audit + "R")
                to = fits.get((symbol - 1) % 4 + 1, {}).get(state)
                if to is not None:
                    put(fresh, to, cost + extra, audit + "K")
        best = fresh
        insert(best)
    return min(best[s] for s in (0, 3) if s in best)


def runs(symbols):
    places, counts = array("b"), array("q")
    for s in symbols:
        if places and places[-1] == s:
            counts[-1] += 1
        else:
            places.append(s)
            counts.append(1)
    return places, counts


def test_cheapest_edits_equal_a_plain_search():
    rng, costs = random.Random(4), conversations.Costs()
    for n in range(400):
        symbols = rng.choices(SYMBOLS, k=rng.randint(0, 12)) if n % 2 else [s for s in rng.choices(SYMBOLS, k=4) for _ in range(rng.randint(1, 6))]
        cost, audit, plan = costs.solve(*runs(symbols))
        assert (cost, audit) == plain_cheapest(symbols)
        assert plan.replace("X", "D").count("D") == sum(s > 0 for s in symbols) - sum(c in "KR" for c in plan)


def test_runs_of_any_length():
    costs = conversations.Costs()
    places, counts = array("b", [1, 2, 0, 7, 2]), array("q", [1, 5001, 3000, 2049, 3])
    cost, audit, _ = costs.solve(places, counts)
    symbols = [s for s, c in zip(places, counts) for _ in range(c)]
    vector, total = conversations.END, 0
    for s in reversed(symbols):
        vector, least = costs.before(s, 1, vector)
        total += least
    assert cost == total + vector[0] and len(audit.replace("I", "")) == len(symbols)
    # A run far too long to be walked is still priced, by a few dozen powers: every second message answers.
    vector, total = costs.before(2, 10**15, conversations.END)
    assert total + vector[0] == 10**15 // 2 and len(costs.powers[2]) == 50


def test_repaired_messages_and_digest(spark):
    rows = conversations.messages(spark.read.parquet(f"{SF}/conversations.parquet"), "conv_id", "turn", "role", "text")
    made, times = conversations.damage(rows)
    found = {r["conv"]: r for r in conversations.diagnose(made, times).collect()}
    whole = {}
    for r in sorted(conversations.repair(made, times).collect(), key=lambda r: (r["conv"], r["place"])):
        whole.setdefault(r["conv"], []).append(r)
    for conv, row in found.items():
        kept = whole.get(conv, [])
        assert [r["place"] for r in kept] == list(range(1, len(kept) + 1))
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in kept))
        assert "".join(r["edit"] for r in kept) == row["audit"].replace("D", "")
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in kept).encode()).hexdigest() == row["repaired_sha256"]


def test_a_conversation_of_most_rows_and_copies(make):
    """Copies are folded before rows are sorted; batches end anywhere in a conversation."""
    talk = [(1, t, "user" if t % 2 else "assistant", f"m {t}.") for t in range(12_000)] + [(1, 5, "user", "copy.")] * 3000 + [(2, 1, "user", "a.")]
    rows = conversations.messages(make("c:long t:long r:string x:string", talk), "c", "t", "r", "x")
    one, two = sorted(conversations.diagnose(rows).collect(), key=lambda r: r["conv"])
    assert (one["duplicate"], one["blank"], one["truncated"], one["gaps"]) == (2999, 0, 0, 0)
    symbols = [3, 2] * 3 + [2] + [0] * 2999 + [3, 2] * 5997
    assert one["cost"] == plain_cheapest(symbols)[0]
    assert Counter(one["audit"].replace("I", ""))["D"] >= 2999 and len(one["audit"].replace("I", "")) == len(symbols)
    assert (two["cost"], two["audit"], two["illegal"]) == (2, "D", 0)
