"""Problems whose results are exactly defined: against brute force, and on nulls, empties, ties, repeats and clashes."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartolex.llm import dressed, leakage, linked, overlap, packing

WORD = re.compile(r"[^\W_]+")
RELEASE = "example_id long, worldcover_code long, polygon_id string, text string, split string, h3_cell string, document_id string, project string"
CLASH = ["rid", "code", "pid", "tup", "k", "n", "cls", "side", "norm", "hub", "spoke", "label", "id", "tokens", "size", "doc", "keep_id", "copies", "component", "x"]


def release(spark, rows):
    """Rows of (id, code, polygon, text, split, cell, document), with columns whose names the operators use inside."""
    df = spark.createDataFrame([(*r, "p") for r in rows], RELEASE)
    return df.withColumns({c: F.lit(1) for c in CLASH})


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


# --- problem 1 ---------------------------------------------------------------------------------------------------


def test_dressed_copies(spark):
    t = "Area: 12 m2; Owner: parish of Ab; Type: moor"
    rows = [
        (1, 10, "a:way/1", "The Path, from A to B.", None, None, None), (2, 10, "A_WAY 1", "the  path from a to b", None, None, None), (3, 20, "a:way/1", "The path from A to B", None, None, None),
        (4, 10, "a:way/1", t, None, None, None), (5, 10, "a:way/1", "TYPE = Moor | AREA = 12 M2 | OWNER = Parish of AB", None, None, None), (6, 10, "a:way/1", "type - moor\narea - 12 m2 // owner - parish of ab", None, None, None),
        (7, 10, "a:way/1", "Area: parish of Ab; Owner: 12 m2; Type: moor", None, None, None), (8, 10, None, "x", None, None, None), (9, 10, None, "x!", None, None, None), (10, None, "q", "x", None, None, None), (11, None, "q", "X", None, None, None),
        (12, 10, "q", None, None, None, None), (13, 10, "q", None, None, None, None), (14, 10, "q", "", None, None, None), (15, 10, "q", " - ", None, None, None), (16, 10, "q", "w " * 60_000, None, None, None), (17, 10, "q", "W\n" * 60_000, None, None, None),
    ]
    df = release(spark, rows)
    want = [(1, 2), (4, 5), (4, 6), (8, 9), (10, 11), (12, 13), (14, 15), (16, 17)]
    assert pairs(dressed.copies(df)) == want
    got = {r["keep_id"]: r["copies"] for r in dressed.collapse(df).collect()}
    assert sum(got.values()) == len(rows) and got[4] == 3 and got[7] == 1


def test_a_hot_record_and_equal_ids(spark):
    df = release(spark, [(i, 10, "p", "same text", None, None, None) for i in range(500)] + [(0, 10, "p", "same text", None, None, None)])
    assert len(pairs(dressed.copies(df))) == 499
    assert [(r["keep_id"], r["copies"]) for r in dressed.collapse(df).collect()] == [(0, 501)]


def test_prose_is_no_set_of_fields(spark):
    df = release(spark, [(1, 1, "p", "One went. Note: two; three", None, None, None), (2, 1, "p", "three; One went. Note: two", None, None, None)])
    assert pairs(dressed.copies(df)) == []


@pytest.mark.parametrize("run", [dressed.copies, dressed.collapse, overlap.cross_split_overlaps, linked.tied_cells, linked.grouped_splits])
def test_empty_table(spark, run):
    assert run(release(spark, [])).count() == 0


# --- problem 3 ---------------------------------------------------------------------------------------------------


def brute_overlaps(rows, least=24):
    runs = {}
    for i, _, _, t, split, *_ in rows:
        w = WORD.findall((t or "").lower())
        if split in ("train", "validation", "test") and len(w) >= least and i is not None:
            runs[i] = (split == "train", set(zip(w, w[1:], w[2:])))
    out = []
    for a, b in combinations(sorted(runs), 2):
        (ta, ra), (tb, rb) = runs[a], runs[b]
        if ta != tb and 5 * len(ra & rb) >= 3 * len(ra | rb):
            out.append((a, b) if ta else (b, a))
    return sorted(out)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(len(words))
        words[k : k + 1] = rng.choice([[], [f"new{rng.randrange(99)}"], [words[k], "more"]])
    return " ".join(words)


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_are_complete(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of", "and"] * 12
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(22, 60))] for _ in range(14)]
    rows = []
    for i in range(160):
        b = base[i % len(base)] if i % 3 else [rng.choice(vocabulary) for _ in range(30)]
        rows.append((i, 1, "p", edited(rng, b, rng.randint(0, 9)), rng.choice(["train", "train", "test", "validation", None, "other"]), None, None))
    rows += [(500, 1, "p", None, "train", None, None), (501, 1, "p", "", "test", None, None), (502, 1, "p", " ".join(base[0]), "train", None, None), (503, 1, "p", " ".join(base[0]).upper(), "test", None, None)]
    # with crowded intervals apart, as of a corpus much larger, and without
    for crowded in (overlap.CROWDED, 6):
        got = overlap.cross_split_overlaps(release(spark, rows), crowded=crowded)
        assert sorted((r["train_id"], r["eval_id"]) for r in got.collect()) == brute_overlaps(rows)


def test_intervals_across_batches():
    """An interval that spans batches is judged as one; the stream holds no more than the open interval."""
    rng = np.random.default_rng(5)
    head = np.sort(rng.integers(0, 40, 600))
    side = rng.choice([1, 1, 1, 2, 3], 600)
    side[head < 12] = 1
    cols = {"head": head, "cls": np.arange(600), "meta": 36 + side}
    whole = pa.record_batch({k: pa.array(v) for k, v in cols.items()})
    cut = [whole.slice(k, 7) for k in range(0, 600, 7)]
    one, many = (pa.Table.from_batches(list(overlap._intervals(iter(x)))).to_pydict() for x in ([whole], cut))
    assert one == many
    want = {h for h in range(40) if (head == h).sum() > 1 and (side[head == h] & 1).any() and (side[head == h] & 2).any()}
    assert set(one["head"]) == want and len(one["head"]) == sum((head == h).sum() for h in want)


def test_overlap_of_texts_beyond_a_million_runs(spark):
    long = [f"{i * 7919 % 1048583:x}" for i in range(1_060_000)]
    rows = [(1, 1, "p", " ".join(long), "train", None, None), (2, 1, "p", " ".join(long[:1_050_000]), "test", None, None)]
    got = overlap.cross_split_overlaps(release(spark, rows)).collect()
    assert [(r["train_id"], r["eval_id"], r["eval_words"]) for r in got] == [(1, 2, 1_050_000)]


def test_overlap_of_very_long_and_repeated_texts(spark):
    long = " ".join(f"a{i % 997} b{i % 41}" for i in range(40_000))
    rows = [(1, 1, "p", long, "train", None, None), (2, 1, "p", long + " tail", "test", None, None)] + [(10 + i, 1, "p", "same " * 30, "train" if i % 2 else "test", None, None) for i in range(10)]
    found, members = overlap.overlapping_classes(release(spark, rows))
    assert found.count() == 2 and members.count() == 12  # the hot text is one class, not 25 pairs
    assert len(pairs(overlap.row_pairs(found, members).select("train_id", "eval_id"))) == 1 + 25
    report = overlap.overlap_report(found, members, release(spark, rows)).collect()
    assert [(r["eval_split"], r["pairs"], r["eval_rows"], r["train_rows"]) for r in report] == [("test", 26, 6, 6)]


# --- problem 6 ---------------------------------------------------------------------------------------------------


def union_find(rows):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for r in rows:
        nodes = [(k, v) for k, v in (("c", r[5]), ("p", r[2]), ("d", r[6])) if v is not None]
        for a, b in zip(nodes, nodes[1:]):
            up[find(a)] = find(b)
        for a in nodes:
            find(a)
    groups = {}
    for x in list(up):
        groups.setdefault(find(x), []).append(x)
    return groups


@pytest.mark.parametrize("seed", range(3))
def test_ties_are_components(spark, seed):
    rng = random.Random(seed)
    pick = lambda kind, n: rng.choice([None] + [f"{kind}{rng.randrange(n)}"] * 8)
    rows = [(i, rng.choice([10, 20, 30]), pick("p", 400), "t", None, pick("c", 120), pick("d", 300)) for i in range(260)]
    rows += [(1000 + i, 10, f"chain{i // 2}", "t", None, f"line{(i + 1) // 2:03d}", None) for i in range(60)]
    want = []
    for g in union_find(rows).values():
        cells = sorted(v for k, v in g if k == "c")
        want += [(cells[0], c) for c in cells[1:]]
    df = release(spark, rows)
    assert pairs(linked.tied_cells(df)) == sorted(want)
    split = {r["example_id"]: r["new_split"] for r in linked.grouped_splits(df).collect()}
    assert len(split) == len(rows) and set(split.values()) <= {"train", "validation", "test"}
    for g in union_find(rows).values():
        inside = {split[r[0]] for r in rows if any((k, v) in set(g) for k, v in (("c", r[5]), ("p", r[2]), ("d", r[6])) if v is not None)}
        assert len(inside) == 1


def test_shares_come_close_even_with_a_third_in_one_group(spark):
    rows = [(i, [10, 20, 30][i % 3], None, "t", None, "hot" if i < 1000 else f"c{i % 700}", None) for i in range(3000)]
    got = Counter(r["new_split"] for r in linked.grouped_splits(release(spark, rows)).collect())
    assert abs(got["train"] / 3000 - 0.8) < 0.02 and abs(got["test"] / 3000 - 0.1) < 0.02


def test_rows_without_entities_are_alone(spark):
    df = release(spark, [(1, None, None, None, None, None, None), (2, None, None, None, None, None, None)])
    got = linked.grouped_splits(df).collect()
    assert len(got) == 2 and len({r["component"] for r in got}) == 2 and linked.tied_cells(df).count() == 0


# --- problem 9 ---------------------------------------------------------------------------------------------------


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("doc", "norm", "item_id", "edits")})


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("seed", range(3))
def test_leaks_are_complete(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["a", "of", "the", "straße", "дом"] + [f"word{i}" for i in range(40)]
    its = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 40)))) for i in range(12)] + [(90, None), (91, "")]
    docs = []
    for i in range(90):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if i % 2:
            src = rng.choice(its[:12])[1].split()
            n = rng.randint(8, 16)
            k = rng.randrange(max(1, len(src) - n))
            at = rng.randrange(len(w) + 1)
            w[at:at] = src[k : k + n]
        docs.append((i, (", " if i % 5 == 0 else " ").join(w).title() if i % 3 else " ".join(w)))
    docs += [(200, None), (201, ""), (202, "x " * 50_000 + its[11][1])]
    grams = lambda t: {tuple(w[i : i + 12]) for w in [WORD.findall((t or "").lower())] for i in range(len(w) - 11)}
    want = sorted((d, i) for d, t in docs for i, u in its if grams(t) & grams(u))
    for few in (2000, 5):  # as one index, and by a shuffle
        got = leakage.leaked(documents(spark, docs), items(spark, its), few=few).select("doc_id", "item_id")
        assert pairs(got) == want


@pytest.mark.parametrize("few", [2000, 3])
def test_recall_of_edited_passages(spark, few):
    """Passages of the sought length with one random edit each: all of them come out, by either way."""
    rng = random.Random(few)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9)))
    its = [(i, " ".join(word() for _ in range(rng.randint(30, 60)))) for i in range(8)]
    least = leakage._least_chars([t for _, t in its], 20)
    docs, want = [], set()
    for d in range(160):
        i, t = its[d % 8]
        at = rng.randrange(len(t) - least)
        passage = list(t[at : at + least + rng.randint(0, 9)].strip())
        for _ in range(d % 2):
            k = rng.randrange(1, len(passage) - 1)
            passage[k : k + 1] = rng.choice([["q"], [], [passage[k], "q"]])
        docs.append((d, " ".join([*(word() for _ in range(rng.randint(0, 40))), "".join(passage).strip(), *(word() for _ in range(5))])))
        if len("".join(passage).strip()) >= least:
            want.add((d, i))
    docs += [(1000 + d, " ".join(word() for _ in range(60))) for d in range(60)]
    got = set(pairs(leakage.leaked(documents(spark, docs), items(spark, its), words=20, exact=False, few=few).select("doc_id", "item_id")))
    assert len(want) > 100 and len(want & got) / len(want) >= 0.99 and all(d < 1000 for d, _ in got)


def test_alignment_against_a_full_table():
    """The banded alignment of diagonals equals the whole table wherever the edits stay within the band."""
    rng = random.Random(4)
    index = leakage.ItemIndex([(1, "x")], 1, 1)
    for _ in range(200):
        item = "".join(rng.choice("ab ") for _ in range(60))
        at = rng.randrange(10)
        region = list(item[at : at + 40])
        for _ in range(rng.randrange(3)):
            k = rng.randrange(len(region))
            region[k : k + 1] = rng.choice([["c"], [], [region[k], "c"]])
        row = [0] * (len(item) + 1)
        for i, ch in enumerate(region, 1):
            last, row = row, [i]
            for j, c in enumerate(item, 1):
                row.append(min(last[j - 1] + (ch != c), last[j] + 1, row[-1] + 1))
        assert index.align(item, "".join(region), at) == min(row)


def test_edited_passages(spark):
    passage = "the warden who lives in the low house opens the gate of the garden at seven minutes past the hour and waits for the last guest"
    one = passage.replace("garden", "gardens")
    docs = [(1, f"before {passage} after"), (2, f"before {one} after"), (3, "nothing of the kind stands in this other text about a wall and a road and a mill"), (4, passage)]
    got = {r["doc_id"]: r["edits"] for r in leakage.leaked(documents(spark, docs), items(spark, [(7, passage)]), words=20, exact=False).collect()}
    assert got == {1: 0, 2: 1, 4: 0}


def test_passages_about_a_replaced_part(spark):
    head = "the warden who lives in the low house opens the gate of the garden at seven minutes past the hour and waits for the last guest"
    tail = "then he walks along the wall of the orchard to feed nine grey geese and two goats before the bell of the chapel rings for supper"
    item = f"{head} who comes from the village of Aldenham by the quiet ferry {tail}"
    other = f"{head} who left on the long road to Kirkbride in one early coach {tail}"  # as long, so that both parts lie on one diagonal
    # an edit in every fourth word before a part that is whole
    rough = " ".join(w + "x" if k % 4 == 1 else w for k, w in enumerate(head.split()))
    mixed = f"{rough} who comes from the village of Aldenham by the quiet ferry {tail}"
    none = " ".join(w[:-1] + "q" if k % 4 == 3 else w for k, w in enumerate(item.split()))
    docs = [(1, f"so {other} and on"), (2, f"so {mixed} and on"), (3, f"so {none} and on"), (4, f"so {item} and on")]
    assert len(other) == len(item)
    got = {r["doc_id"]: (r["size"], r["edits"]) for r in leakage.leaked(documents(spark, docs), items(spark, [(7, item)]), words=20, exact=False).collect()}
    assert set(got) == {1, 2, 4} and all(n >= 94 and e <= 2 for n, e in got.values()) and got[4][0] >= len(item)


def test_no_items_no_documents(spark):
    assert leakage.leaked(documents(spark, []), items(spark, [(1, "a " * 20)])).count() == 0
    assert leakage.leaked(documents(spark, [(1, "a " * 20)]), items(spark, [])).count() == 0
    assert leakage.leaked(documents(spark, [(1, "a b c")]), items(spark, [(i, "a") for i in range(3)]), few=1).count() == 0


# --- problem 8 ---------------------------------------------------------------------------------------------------


def test_triple_behind_many_longer_lengths():
    import numpy as np

    have = np.zeros(2049, np.int64)
    have[1300:1400] = 1
    have[500] = 3
    assert packing._complement(have, 1500) == (500, 500, 500)
    for seed in range(40):  # three available lengths or none, as trying all says
        rng = random.Random(seed)
        gap = rng.randint(20, 60)
        have = np.zeros(61, np.int64)
        have[[rng.randint(1, 60) for _ in range(rng.randint(2, 6))]] = rng.randint(1, 3)
        items = [k for k in range(61) for _ in range(min(3, have[k]))]
        want = any(sum(c) == gap for n in (1, 2, 3) for c in combinations(items, n))
        got = packing._complement(have, gap)
        assert bool(got) == want and (not got or sum(got) == gap and all(have[x] >= n for x, n in Counter(got).items()))


@pytest.mark.parametrize("seed", range(6))
def test_packing_uses_every_item_once(seed):
    rng = random.Random(seed)
    cap = rng.choice([7, 32, 100])
    counts = Counter(rng.randint(1, cap) for _ in range(rng.randint(0, 800)))
    got = packing.pack(dict(counts), cap)
    used = Counter()
    for times, pattern in got:
        assert times > 0 and sum(pattern) <= cap
        for x in pattern:
            used[x] += times
    assert +used == +counts
    bins, lower = sum(t for t, _ in got), -(-sum(k * n for k, n in counts.items()) // cap)
    assert lower <= bins <= 1.5 * lower + 1


def test_exact_sums_are_found():
    assert packing.pack({10: 1, 6: 2, 4: 2, 5: 1, 3: 1, 2: 1}, 10) and sum(t for t, _ in packing.pack({10: 1, 6: 2, 4: 2, 5: 1, 3: 1, 2: 1}, 10)) == 4


def test_containers(spark):
    sizes = [0, 1, 5, 10, 10, 11, 25, 30, 7, 3, 3, 3] + [4] * 50
    lengths = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)] + [(0, 2)], "id long, tokens long")
    df = spark.createDataFrame([], "doc_id long, text string")
    rows = packing.containers(df, 10, lengths=lengths).collect()
    fill, parts = Counter(), Counter()
    for r in rows:
        parts[r["doc_id"]] += r["tokens"]
        if r["container"] is not None:
            fill[r["container"]] += r["tokens"]
    assert max(fill.values()) <= 10 and set(fill) == set(range(len(fill)))
    assert parts == Counter({i: n for i, n in enumerate(sizes)}) + Counter({0: 2})
    for i, n in enumerate(sizes):
        if n <= 10 and i:
            assert sum(r["doc_id"] == i for r in rows) == 1
    assert [r["container"] for r in rows if r["tokens"] == 0] == [None]


def test_containers_of_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (3, "one two"), (4, "word " * 5000)], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("id", "size", "r", "rank", "part")})
    rows = packing.containers(df, 512).collect()
    by = Counter(r["doc_id"] for r in rows)
    assert by[1] == by[2] == 1 and by[3] == 2 and by[4] > 5
    assert packing.containers(df.limit(0), 512).count() == 0
