import hashlib
import random
import re
import time

import numpy as np
from corpus import frame

from surveyloom.llm.pii import KINDS, Spans, Trees, base_spans, candidates, digests, find_personal_data, luhn, select


def plain(text):
    """The base kinds as their patterns say."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for kind, pattern, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 12, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == 3 or luhn(digits)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(8)
    for _ in range(20_000):
        text = "".join(rng.choice("aB1239..@@+-( )%_é") for _ in range(rng.randint(0, 40)))
        assert base_spans(text) == plain(text)
    for text in ("a@b.c@d.e", "x@y.z.w.", "1.2.3.4.5.6.7.8", "256.1.1.1", "0000255.1.1.1", "4111 1111-1111 1111", "+1 (2) 3.4567890"):
        assert base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    for run in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" * 150_000, "12 " * 100_000):
        base_spans(run)
        candidates(run)
    assert time.perf_counter() - start < 20


def joined(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def data(n=700):
    rng = random.Random(4)

    def card(good):
        d = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        check = next(c for c in "0123456789" if luhn(d + c))
        return d + (check if good else str((int(check) + 3) % 10))

    rows = []
    for i in range(n):
        kind = i % 7
        word = "".join(rng.choice("aeinorst") for _ in range(6))
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(32))
        text = [
            f"{word} mail {word}{i}@mail.example.com now", f"{word} host 10.{i % 256}.3.4 up",
            f"{word} paid {card(True)} today", f"call +1 (555) 555-{1000 + i} {word}", f'{word} token = "{secret}"',
            f"order {card(False)} {word} version 1.2.{i}", f"{word} plain text in 19{i % 90 + 10}",
        ][kind]
        rows.append((i, text, "en", "s", 1, 1, "x", 1))
    # a secret nobody introduces
    rows.append((n, "see 9f86d081884c7d659a2feaa0c55ad015 there", "en", "s", 1, 1, "x", 1))
    return rows


def test_base_stays_and_the_trees_add(spark):
    rows = data()
    found = find_personal_data(frame(spark, rows))
    got = {r.doc_id: r for r in digests(found).collect()}
    for r in rows:
        known, mine = plain(r[1]), got[r[0]]
        assert mine.base_sha256 == hashlib.sha256(joined(known).encode()).hexdigest()
        counts = np.bincount([k for _, k, _ in known], minlength=4)
        assert [mine.n_email, mine.n_ip, mine.n_card, mine.n_phone] == counts[:4].tolist()
        assert set(filter(None, joined(known).split(","))) <= set(mine.spans.split(","))
    assert got[len(rows) - 1].spans == "secret:4:36"
    # numbers that fail the check are no cards
    assert all(got[r[0]].spans == "" for r in rows if r[1].startswith("order"))


def test_odd_rows(odd, empty):
    got = digests(find_personal_data(odd)).collect()
    assert len(got) == 7 and all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got)
    assert find_personal_data(empty).collect() == []


def test_numbers_in_a_format_of_their_own_are_added(spark):
    """National numbers that a word introduces teach the trees to know others; numbers of orders do not become phones."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        number = f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
        order = f"{rng.randint(10**6, 10**9)}"
        text = [f"please call {number} soon", f"my phone: {number}.", f"order {order} came", f"invoice {order}, paid", f"+1 {number} or so"][i % 5]
        rows.append((i, text, "en", "s", 1, 1, "x", 1))
    asked = ["we met at (555) 123-4567 then", "there were 8812345 of them", "write joe@localhost"]
    rows += [(1000 + i, t, "en", "s", 1, 1, "x", 1) for i, t in enumerate(asked)]
    got = {r.doc_id: r for r in digests(find_personal_data(frame(spark, rows))).collect()}
    assert got[1000].spans == "phone:10:24" and got[1000].n_phone == 0
    assert got[1001].spans == ""
    assert all(got[i].spans == "" for i in range(900) if i % 5 in (2, 3))


def test_nothing_is_too_long_to_be_proposed():
    token, number = "a1" * 100, "12345678" * 4
    dotted, local = ".".join(["123"] * 12), "x" * 300
    text = f"{token} and {number} and {dotted} and {local}@host {local}"
    found = {(k, text[s:e]) for s, k, e in candidates(text)}
    assert {(4, token), (2, number), (1, dotted), (0, local + "@host")} <= found


def test_spans_that_touch():
    rng = random.Random(3)
    for _ in range(300):
        spans = [(s, 0, s + rng.randint(1, 9)) for s in (rng.randint(0, 60) for _ in range(rng.randint(0, 8)))]
        asked = Spans(spans)
        for start in range(0, 62, 3):
            end = start + rng.randint(1, 5)
            assert asked.touch(start, end) == any(s < end and start < e for s, _, e in spans)


def test_very_many_numbers_in_a_text():
    """Time grows with the text, not with pairs of its spans."""
    trees = Trees(threshold=np.full(len(KINDS), -1.0))
    took = []
    for n in (4000, 16_000):
        text = " x ".join(f"555 {i:07d}" if i % 2 else f"+1 555 {i:07d}" for i in range(n))
        start = time.perf_counter()
        chosen = select(text, base_spans(text), trees)
        took.append(time.perf_counter() - start)
        assert len(chosen) == n // 2
    assert took[1] < 8 * took[0]
