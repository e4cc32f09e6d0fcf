import hashlib
import random

import numpy as np
import pytest
from corpus import frame

from surveyloom.llm.line_dedup import LineRule, bags_near, drop_repeated_lines, long_lines, within
from surveyloom.llm.words import U64


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def change(rng, text, n):
    own = list(text)
    for _ in range(n):
        at, what = rng.randrange(len(own) + 1), rng.random()
        if what < 0.3:
            own.insert(at, rng.choice("abcé"))
        elif own and what < 0.6:
            own.pop(min(at, len(own) - 1))
        elif own:
            own[min(at, len(own) - 1)] = rng.choice("abcé")
    return "".join(own)


def test_bits_of_the_band_are_edit_distance():
    rng = random.Random(6)
    left = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 12))) for _ in range(1500)]
    right = [change(rng, a, rng.randint(0, 4)) for a in left]
    for edits in (0, 1, 2, 3):
        assert within(left, right, edits).tolist() == [distance(a, b) <= edits for a, b in zip(left, right)]


def test_near_lines_have_near_bags():
    rng = random.Random(7)
    left = ["".join(rng.choice("abcdefg hé") for _ in range(300)) for _ in range(200)]
    right = [change(rng, a, 2) for a in left]
    bags = [np.concatenate([x.bags() for x in long_lines([t], 1)]) for t in left + right]
    a, b = (np.array([x[0] for x in part], dtype=U64) for part in (bags[:200], bags[200:]))
    assert bags_near(a, b, 2).all()
    assert not bags_near(a[:-1], a[1:], 2).any()


def brute(rows, rule):
    """Lines to go with the line that stands for them, and links by line, all pairs compared."""
    seen = {}
    for r in rows:
        doc = r[0] if r[0] is not None else 1 << 62
        for i, line in enumerate((r[1] or "").split("\n")):
            if len(line) >= rule.least or (rule.short and line.strip(" \t\n\r\x0b\x0c")):
                seen.setdefault(line, set()).add((doc, i))
    lines = sorted(seen)
    up, links = {x: x for x in lines}, dict.fromkeys(lines, 0)

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    pairs = {}
    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            edits = rule.allowed(min(len(a), len(b)))
            if edits and abs(len(a) - len(b)) <= edits:
                pairs.setdefault(edits, []).append((a, b))
    for edits, own in pairs.items():
        for (a, b), near in zip(own, within([p[0] for p in own], [p[1] for p in own], edits)):
            if near:
                up[top(a)] = top(b)
                links[a] += 1
                links[b] += 1
    first = {}
    for x in lines:
        first[top(x)] = min(first.get(top(x), (1 << 63, 0)), min(seen[x]))
    return {p: first[top(x)] for x in lines for p in seen[x] if p > first[top(x)]}, links


def check(got, rows, rule):
    want, links = brute(rows, rule)
    for r in rows:
        g = got[r[0]]
        lines = (r[1] or "").split("\n")
        gone = [i for i in range(len(lines)) if (r[0], i) in want]
        assert (g.n_lines, g.n_removed, g.removed) == (len(lines), len(gone), gone)
        assert list(zip(g.class_doc, g.class_line)) == [want[r[0], i] for i in gone]
        assert g.n_links == sum(links.get(x, 0) for x in lines)
        assert g.kept_text == "\n".join(x for i, x in enumerate(lines) if i not in gone)
        assert g.kept_sha256 == hashlib.sha256(g.kept_text.encode()).hexdigest()
    return len(want)


@pytest.mark.parametrize("rule", [LineRule(), LineRule(short=True), LineRule(edits=3, least=30, short=True)])
def test_lines_of_the_corpus(docs, rows, rule):
    got = {r.doc_id: r for r in drop_repeated_lines(docs, rule).collect()}
    assert check(got, rows, rule) > 10


def test_short_lines_are_the_same_within_fewer_edits(spark):
    rng, rule = random.Random(12), LineRule(short=True)
    rows = []
    for i in range(90):
        size = rng.choice([4, 18, 19, 20, 21, 30, 36, 38, 39, 40, 41, 42])
        line = "".join(rng.choice("abcd ") for _ in range(size))
        rows.append((i, "\n".join([line, change(rng, line, 1), change(rng, line, 2)]), "en", "s", 1, 1, "x", 1))
    got = {r.doc_id: r for r in drop_repeated_lines(frame(spark, rows), rule).collect()}
    assert check(got, rows, rule) > 30
    assert [rule.allowed(n) for n in (3, 19, 20, 39, 40, 900)] == [0, 0, 1, 1, 2, 2]


def test_lines_that_differ_everywhere_stay(spark):
    """A word of Thue and Morse and its complement have equal sums for any odd base."""
    for bits in (10, 11, 13):
        word = [bin(i).count("1") % 2 for i in range(1 << bits)]
        left, right = ("".join("ab"[b ^ flip] for b in word) for flip in (0, 1))
        blocks = "".join(("ab" * 32, "ba" * 32)[b] for b in word[:1024])
        swapped = "".join(("ab" * 32, "ba" * 32)[1 - b] for b in word[:1024])
        rows = [(1, left + "\n" + blocks, "", "", 1, 1, "", 1), (2, right + "\n" + swapped, "", "", 1, 1, "", 1)]
        got = drop_repeated_lines(frame(spark, rows), LineRule(short=True)).collect()
        assert [r.n_removed for r in got] == [0, 0]


def test_ids_are_of_the_line_alone():
    lines = ["a", "ab", "x" * 63, "x" * 64, "x" * 65, "y" * 5000, "z" * 70_000, "é" * 64]
    alone = {x: [next(long_lines([x], 1)).ids(k)[0] for k in (0, 1)] for x in lines}
    together = next(long_lines(["\n".join(lines)], 1))
    assert [together.ids(k).tolist() for k in (0, 1)] == [[alone[x][k] for x in lines] for k in (0, 1)]
    assert len({i for own in alone.values() for i in own}) == 2 * len(lines)


def test_one_very_long_line(spark):
    rng = random.Random(13)
    line = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    rows = [(i, t, "", "", 1, 1, "", 1) for i, t in enumerate([line, line + "\nx", change(rng, line, 2), "y" + line[:-9]])]
    got = {r.doc_id: r.n_removed for r in drop_repeated_lines(frame(spark, rows), LineRule(short=True)).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 0}


def test_near_lines_chains_and_other_thresholds(spark):
    rng = random.Random(9)
    rows, line = [], "".join(rng.choice("abcdefgh ") for _ in range(50))
    for i in range(60):
        line = change(rng, line, rng.randint(0, 3))
        rows.append((i, f"head {i}\n{line}\n\nshort\n{line}x", "en", "s", 1, 1, "x", 1))
    for rule in (LineRule(), LineRule(edits=1, least=30), LineRule(edits=3, least=30)):
        got = {r.doc_id: r for r in drop_repeated_lines(frame(spark, rows), rule).collect()}
        assert check(got, rows, rule) > 10


def test_odd_rows(odd, empty, spark):
    got = drop_repeated_lines(odd).collect()
    by = sorted((r.doc_id if r.doc_id is not None else 99, r.n_removed, r.n_lines) for r in got)
    # the same place of one document stays; the copy without id comes after it
    assert by == [(1, 0, 1), (1, 0, 1), (2, 0, 1), (2, 0, 1), (7, 0, 1), (99, 0, 1), (99, 1, 1)]
    assert drop_repeated_lines(empty).collect() == []


def test_short_lines_that_repeat_go_and_blank_ones_stay(spark):
    rng, rule = random.Random(10), LineRule(short=True)
    rows = []
    for i in range(40):
        lines = [rng.choice(["menu", "  menu", "é", "own " * 12, "", " \t", f"only {i}"]) for _ in range(12)]
        rows.append((i, "\n".join(lines), "en", "s", 1, 1, "x", 1))
    got = {r.doc_id: r for r in drop_repeated_lines(frame(spark, rows), rule).collect()}
    seen, total = set(), 0
    for d, text, *_ in rows:
        gone = []
        for i, line in enumerate(text.split("\n")):
            if line.strip() and line in seen:
                gone.append(i)
            seen.add(line)
        assert got[d].removed == gone
        total += len(gone)
    assert total > 100
