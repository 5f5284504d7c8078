"""Edit join of lines against all pairs."""

from __future__ import annotations

import itertools
import random

import pytest

from addrwatch.llm import lines


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for c in a:
        last, row = row, [row[0] + 1]
        for j, d in enumerate(b):
            row.append(min(last[j + 1] + 1, row[-1] + 1, last[j] + (c != d)))
    return row[-1]


def edited(rng: random.Random, text: str, n: int) -> str:
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            chars.insert(at, rng.choice("abé"))
        elif at < len(chars):
            chars[at : at + 1] = [] if kind == 1 else [rng.choice("abé")]
    return "".join(chars)


def test_banded_distance_and_shared_segments():
    rng = random.Random(1)
    for _ in range(1500):
        t = rng.randrange(1, 5)
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(0, 30)))
        b = edited(rng, a, rng.randrange(0, 6))
        near = distance(a, b) <= t
        assert lines.within([a], [b], t)[0] == near
        if near and min(len(a), len(b)) > t:
            own = sorted((a, b), key=len)
            line, key, indexed = lines.keys(*lines._points(own), t)
            assert set(key[(line == 0) & indexed]) & set(key[line == 1])


def test_what_a_line_shows_of_others():
    rng = random.Random(4)
    for _ in range(800):
        t = rng.randrange(1, 4)
        head = "".join(rng.choice("abé") for _ in range(rng.randrange(5, 90)))
        x, y = (edited(rng, head, rng.randrange(0, 7)) for _ in range(2))
        seen = {}
        for z in (x, y):
            first, reach, near = seen[z] = lines._seen_from(head, z, t)
            assert head[:first] == z[:first] and head[first : first + 1] != z[first : first + 1] or first in (len(head), len(z))
            assert near == min(distance(head, z), 2 * t + 1)
            assert reach == max(p for p in range(len(head) + 1) if any(distance(head[:p], z[:q]) <= t for q in range(max(0, p - t), min(len(z), p + t) + 1)))
        if distance(x, y) <= t:
            (a, b, near), (c, _, other) = sorted((seen[x], seen[y]))
            assert c <= b or min(near, other) <= t
            assert max(near, other) <= 2 * t or min(near, other) > t


def plain(docs, threshold, min_chars):
    """Kept texts: of every class of lines the first one."""
    places = [(d, i, x) for d, t in docs for i, x in enumerate((t or "").split("\n")) if x.strip(" \t\r\x0b\x0c")]
    first = {}
    for d, i, x in places:
        first[x] = min(first.get(x, (9e9, 0)), (d, i))
    group = {x: x for x in first}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in itertools.combinations([x for x in first if len(x) >= min_chars], 2):
        if abs(len(a) - len(b)) <= threshold and distance(a, b) <= threshold:
            group[find(a)] = find(b)
    stay = {}
    for x, at in first.items():
        stay[find(x)] = min(stay.get(find(x), (9e9, 0)), at)
    keep = set(stay.values())
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if not x.strip(" \t\r\x0b\x0c") or (d, i) in keep)
            for d, t in docs}


@pytest.mark.parametrize("paired", [32, 2])
def test_lines_kept_are_those_of_all_pairs(spark, monkeypatch, paired):
    monkeypatch.setattr(lines, "PAIRED", paired)
    monkeypatch.setattr(lines, "GROUP", 3)
    rng = random.Random(paired)
    base = ["".join(rng.choice("abcdefgé ") for _ in range(rng.randrange(6, 40))) for _ in range(12)]
    pool = base + [edited(rng, rng.choice(base), rng.randrange(0, 5)) for _ in range(80)] + [f"a common beginning of {k}" for k in range(30)]
    docs = [(i, "\n".join(rng.choice([*pool, "", "  "]) for _ in range(rng.randrange(0, 7)))) for i in range(50)] + [(50, None), (51, ""), (52, "\n")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(df, threshold=2, min_chars=8).collect()}
    assert got == plain(docs, 2, 8)


def test_repeated_rows_keep_the_lines_once(spark):
    df = spark.createDataFrame([(1, "some line\nother"), (1, "some line\nother"), (None, "some line")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["text"], r["n_lines"], r["n_removed"]) for r in lines.dedup_lines(df).collect())
    assert got == [(0, "", 1, 1), (1, "", 2, 2), (1, "some line\nother", 2, 0)]


COMMON = "a very common beginning "


def digits(rng):
    """Several hundred lines of one length and beginning, in many classes."""
    pool = set()
    for _ in range(70):
        own = [rng.choice("0123456789") for _ in range(9)]
        for _ in range(7):
            x = own[:]
            for k in rng.sample(range(9), rng.choice([1, 2])):
                x[k] = rng.choice("0123456789")
            pool.add(COMMON + "".join(x))
    pool = sorted(pool)
    rng.shuffle(pool)
    return pool


def linked(pool):
    """All pairs within two edits; a common beginning changes no distance."""
    return [(a, b) for a, b in itertools.combinations(pool, 2) if distance(a[len(COMMON):], b[len(COMMON):]) <= 2]


def test_classes_of_many_lines_that_differ_in_digits(spark):
    """The least line of a bucket need not be one that the others were verified against before."""
    pool = digits(random.Random(1))
    df = spark.createDataFrame(list(enumerate(pool)), "doc_id long, text string").repartition(7)
    got = {r["doc_id"]: r["text"] for r in lines.dedup_lines(df).collect()}
    place = {x: i for i, x in enumerate(pool)}
    first = list(range(len(pool)))
    pairs = linked(pool)
    for _ in pool:
        before = first[:]
        for a, b in pairs:
            first[place[a]] = first[place[b]] = min(first[place[a]], first[place[b]])
        if first == before:
            break
    assert len(set(first)) > 20
    assert got == {i: x if first[i] == i else "" for i, x in enumerate(pool)}


@pytest.mark.parametrize(("group", "pairs"), [(512, 1 << 16), (40, 50)])
def test_links_are_those_of_all_pairs(spark, monkeypatch, group, pairs):
    monkeypatch.setattr(lines, "GROUP", group)
    monkeypatch.setattr(lines, "PAIRS", pairs, raising=False)
    rng = random.Random(3)
    star = ["x" * k + "one line that is changed in a place or two" + "y" * (2 - k) for k in range(3)]
    star += sorted({edited(rng, star[0], 1) for _ in range(60)})
    pool = digits(rng)[:200]
    every = [*dict.fromkeys(pool + star)]
    near = linked(pool) + [(a, b) for a, b in itertools.combinations(every[len(pool):], 2) if distance(a, b) <= 2]
    wanted = dict.fromkeys(every, 0)
    for a, b in near:
        wanted[a] += 1
        wanted[b] += 1
    df = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in lines.dedup_lines(df).collect()}
    assert {x: got[i]["n_links"] for i, x in enumerate(every)} == wanted
    ids = {x: c["class_id"] for i, x in enumerate(every) for c in got[i]["line_classes"]}
    assert set(ids) == {x for x in every if wanted[x]}
    assert all(ids[a] == ids[b] for a, b in near)
    assert len(set(ids.values())) == sum(got[i]["n_removed"] == 0 and wanted[x] > 0 for i, x in enumerate(every))


def test_few_long_pairs_are_compared_like_many(spark, monkeypatch):
    """Pair by pair or column by column, the answers are those of the full matrix, and long lines take no step per column."""
    rng = random.Random(8)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abé🙂") for _ in range(rng.randrange(0, 30)))
        pairs.append((a, edited(rng, a, rng.randrange(0, 4))))
    wanted = [distance(a, b) <= 2 for a, b in pairs]
    many = lines.within(*map(list, zip(*pairs * 40, strict=True)), 2)
    assert many.tolist() == wanted * 40
    assert [bool(lines.within([a], [b], 2)[0]) for a, b in pairs] == wanted
    monkeypatch.setattr(lines, "_distances", None)
    long = "".join(rng.choice("abcdef ") for _ in range(20000))
    others = [long + "x", "y" + long[1:], long[:9000] + long[9003:], long[:9000] + "zz" + long[9000:], long[::-1]]
    assert lines.within([long] * 5, others, 2).tolist() == [True, True, False, True, False]


def test_a_bucket_is_divided_in_a_task_as_by_rounds(spark, monkeypatch):
    pool = digits(random.Random(5))[:90]
    monkeypatch.setattr(lines, "PAIRED", 12)
    df = spark.createDataFrame(list(enumerate(pool)), "doc_id long, text string").repartition(5)

    def found():
        return {r["doc_id"]: (r["text"], r["n_links"], r["line_classes"]) for r in lines.dedup_lines(df).collect()}

    rounds, measured = [], lines._measured
    monkeypatch.setattr(lines, "_measured", lambda *given: rounds.append(1) or measured(*given))
    whole = found()
    assert not rounds  # no jobs of Spark for a bucket that a task can hold
    wanted = dict.fromkeys(pool, 0)
    for a, b in linked(pool):
        wanted[a] += 1
        wanted[b] += 1
    assert {pool[i]: n for i, (_, n, _) in whole.items()} == wanted
    monkeypatch.setattr(lines, "HERE", 30)  # by rounds until a task can go on
    assert found() == whole
    assert rounds
