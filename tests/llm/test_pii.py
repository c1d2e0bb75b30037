import hashlib
import random
import re
from collections import defaultdict

from docquarry.llm import pii

#: The contract's patterns, as they stand.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+".replace(r"\x20", " "),
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def texts():
    random.seed(5)
    parts = ["a@b.c", "x.y%z@ex-1.example.com", "1.2.3.4", "256.1.1.1", "001.2.3.4.5", "4417 1234 5678 9113", "4417-1234-5678-9113", "+1 (555) 010-0123", "+49.30.123456", "@", ".", "-", " ", "_", "é", "🙂", "\n", "12", "a", "+", "00", "4539578763621486", "(", ")"]
    out = ["".join(random.choice(parts) for _ in range(random.randint(1, 14))) for _ in range(700)]
    return [*out, None, "", " ", "1" * 30000, "a.b" * 20000, "a@b" + ".c" * 5000, "9 " * 20000, "x@y.z " * 700, "+1" + "2 " * 9000]


def test_base_spans_match_the_contract(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, k int, spans string")
    got = {r.doc_id: r for r in pii.report(df).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = brute(text)
        assert got[i].base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest(), text
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == x for k, _, _ in want) for x in BASE]
        assert set(listed(want).split(",")) <= set(got[i].spans.split(","))


def test_high_confidence_patterns_find_unseen_identifiers(spark):
    valid = [x for x in map(str, range(4417123456789000, 4417123456789400)) if luhn(x) and x != "4417123456789113"][:20]
    rows = [(i, f"Please charge card number {c} for the order") for i, c in enumerate(valid)]
    rows += [(100, "Please charge card number 4417123456789114 for the order"), (101, "the serial 4417123456789114 of a part"), (102, "a long run 9999999999999999 of nines"), (100, "Please charge card number 4417123456789114 for the order")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.spans) for r in pii.report(df).collect())
    assert [s for i, s in got if i == 100] == ["card:26:42"] * 2
    assert [s for i, s in got if i in (101, 102)] == ["", ""]
    texts = sorted((r.doc_id, r.text) for r in pii.masked(df).collect())
    assert len(texts) == len(rows)
    assert texts[0][1] == texts[20][1] == "Please charge card number <CARD> for the order"
    assert texts[-2][1] == rows[-3][1]


def brute_discovery(extracted, rounds=2, confidence=0.9, seeds=3):
    """The pattern-instance graph in plain Python: spans that are added, by (id, kind, start, end)."""
    seen = [(r.id, h, p) for r in extracted for h in r.seen or [] for p in ("2 " + h.left, "1 " + h.near + "|" + h.right) if any(c.isalpha() for c in p)]
    edges = {(p, h.m, h.k) for _, h, p in seen}
    instances = defaultdict(set)
    for p, m, k in edges:
        instances[p].add((m, k))
    known = {(m, k): 1.0 for _, m, k in edges if k < pii.CANDIDATE}
    accepted, found = {}, {}
    for _ in range(rounds):
        accepted = {}
        for p, own in instances.items():
            for kind in range(len(pii.NAMES)):
                scores = [known[m, k] if k < pii.CANDIDATE else found[m][1] for m, k in own if (k == kind and k < pii.CANDIDATE) or (k == pii.CANDIDATE and m in found and found[m][0] == kind)]
                told = sum(k < pii.CANDIDATE or m in found for m, k in own)
                weight = told + pii.DOUBT * (len(own) - told)
                if len(scores) >= seeds and sum(scores) >= confidence * weight:
                    accepted[p, kind] = sum(scores) / (weight + 0.1)
        miss = defaultdict(lambda: 1.0)
        for (p, kind), c in accepted.items():
            for m, k in instances[p]:
                if k == pii.CANDIDATE:
                    miss[m, kind] *= 1 - c
        best = {}
        for (m, kind), x in miss.items():
            best[m] = max(best.get(m, (-1.0, -1)), (1 - x, kind))
        found = {m: (kind, min(score, 0.99)) for m, (score, kind) in best.items() if score >= confidence}
    out = set()
    for i, h, p in seen:
        for kind in range(len(pii.NAMES)):
            if (p, kind) in accepted and (h.k == kind == pii.SECRET or h.k == pii.CANDIDATE and h.m in found and found[h.m][0] == kind):
                out.add((i, kind, h.s, h.e))
    return out


def test_graph_scores_match_brute_force(spark):
    random.seed(33)
    digits = lambda n: "".join(random.choice("0123456789") for _ in range(n))
    makers = [lambda: f"+49 30 {digits(7)}", lambda: "".join(random.choice("0123456789abcdef") for _ in range(40)), lambda: f"(0{digits(2)}) {digits(5)}", lambda: f"ID{digits(6)}", lambda: f"{digits(1)}.{digits(2)}.{digits(1)}.9", lambda: f"user{digits(2)}@host"]
    pool = [[make() for _ in range(25)] for make in makers]
    frames = ["call %s now", "key = \"%s\" ok", "please dial the %s or", "sum of %s and", "from %s we", "token %s :"]
    likely = {0: [0, 2], 1: [1, 5], 2: [0, 2], 3: [3, 1], 4: [4], 5: [4, 2]}
    rows = []
    for i in range(1500):
        kind = random.randrange(len(makers))
        frame = frames[random.choice(likely[kind]) if random.random() < 0.98 else random.randrange(len(frames))]
        rows.append((i, frame % random.choice(pool[kind])))
    extracted = pii.extract(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    for confidence, rounds, least in ((0.9, 2, 0), (0.45, 2, 50), (0.3, 1, 50), (0.3, 3, 200)):
        got = {tuple(r) for r in pii.discover(extracted, confidence=confidence, rounds=rounds).select("id", "k", "s", "e").collect()}
        assert got == brute_discovery(extracted.collect(), rounds, confidence) and len(got) >= least
    assert {k for _, k, _, _ in got} >= {pii.KINDS.index("phone"), pii.SECRET}


def test_secrets_are_found_by_their_contexts_alone(spark):
    random.seed(34)
    token = lambda n=40: "".join(random.choice("0123456789abcdef") for _ in range(n - 2)) + "a1"
    rows = [(i, f'the config says token = "{token()}" and more text {i}') for i in range(60)]
    rows += [(100 + i, f'the config says token = "{x}" and more') for i, x in enumerate(["tk-8F3kQz-99", token(39), "pass.word-2024"])]
    # The same form in places that say nothing is no secret: checksums among other numbers.
    rows += [(200 + i, f"part no {token() if i % 4 == 0 else 'n%06d' % i} shipped") for i in range(40)]
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    start = rows[0][1].index('"') + 1
    assert all(got[i] == f"secret:{start}:{t.rindex(chr(34))}" for i, t in rows if i < 200)
    assert all(got[i] == "" for i in got if i >= 200)
    texts = {r.doc_id: r.text for r in pii.masked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert texts[0] == 'the config says token = "<SECRET>" and more text 0' and texts[200] == rows[63][1]


def test_precision_and_recall_on_planted_identifiers(spark):
    """Unseen identifiers among decoys that look like them: of what is found, and of what there is."""
    random.seed(35)
    word = lambda: "".join(random.choice("bdgklmnprst") + random.choice("aeiou") for _ in range(random.randint(2, 4)))
    fill = lambda: " ".join(word() for _ in range(random.randint(5, 30)))
    number = lambda: f"0{random.randint(20, 99)}/{random.randint(10**5, 10**6)}"
    intro = ["reach me by phone at", "my mobile number is", "call our office on"]
    rows = [(i, f"{fill()} {random.choice(intro)} +49 30 {random.randint(10**6, 10**7)} {fill()}") for i in range(400)]
    want = {}
    for i in range(1000, 1200):
        x, before = number(), fill() + " " + random.choice(intro) + " "
        rows.append((i, f"{before}{x} {fill()}"))
        want[i] = f"phone:{len(before)}:{len(before) + len(x)}"
    rows += [(2000 + i, f"{fill()} {word()} {number()} {fill()}") for i in range(400)]  # fractions of other things
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id >= 1000 and r.spans}
    right = sum(got.get(i) == s for i, s in want.items())
    assert right >= 0.95 * len(got) and right >= 0.95 * len(want)


def test_masks_keep_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "mail a@b.c now", "raw", 5, "x", 2)], "doc_id long, text string, __text string, __id int, __spans string, __th int")
    (row,) = pii.masked(df).collect()
    assert row["text"] == "mail <EMAIL> now" and tuple(row)[2:] == ("raw", 5, "x", 2)


def test_masks_merge_overlaps_and_keep_other_columns(spark):
    text = "🙂 1.2.3.4@ex.com +1 555 010 0123, end"
    df = spark.createDataFrame([(1, text, "a", 3), (None, None, None, None), (None, "x", "b", 1)], "doc_id long, text string, s string, k int")
    rows = {(r.doc_id, r.s): r for r in pii.masked(df).collect()}
    assert rows[1, "a"].text == "🙂 <EMAIL> <PHONE>, end"
    assert rows[None, None].text is None and rows[None, "b"].text == "x" and rows[1, "a"].k == 3
    assert pii.masked(df.limit(0)).count() == 0 and pii.report(df.limit(0)).count() == 0


def test_contexts_find_identifiers_of_shapes_that_no_seed_has(spark):
    rows = [(i, f"please call me at +49 30 555 {i:04d} before noon") for i in range(150)]
    local = ["(030) 555 %04d", "030/555%04d", "555 %04d 17", "x555-%04d"]
    new = [local[i % 4] % i for i in range(12)]
    rows += [(1000 + i, f"please call me at {x} before noon") for i, x in enumerate(new)]
    # Known from those contexts, the instances make a pattern of their own, which finds what no seed's context holds.
    rows += [(2000 + i, f"my desk line is {x} this year") for i, x in enumerate([*new, "0049(30)5550199"])]
    rows += [(3000 + i, f"part number {x} is out of stock") for i, x in enumerate(["555 0001 17", "77 1234 5678", "AB12345", "0049(30)5550198"])]
    got = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        if 1000 <= i < 3000:
            start = len("please call me at ") if i < 2000 else len("my desk line is ")
            end = text.index(" before" if i < 2000 else " this")
            assert got[i] == f"phone:{start}:{end}", text
    assert all(got[i] == "" for i in range(3000, 3004))


def test_time_grows_with_the_length_of_a_text(spark):
    """A text of 1.3 MB with 160,000 matches takes seconds, in each of its steps; its spans are those of plain Python."""
    import time

    took = []
    for n in (40_000, 160_000):
        text = " ".join(f"u{k % 97}@e.io" if k % 3 else f"+49 30 12345{k % 89:02d}," if k % 2 else f"id{k % 83:03d}" for k in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        began = time.monotonic()
        (row,) = pii.report(df).collect()
        (masked,) = pii.masked(df).collect()
        took.append(time.monotonic() - began)
        want = brute(text)
        assert row.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest() and row.n_email == sum(k == "email" for k, _, _ in want)
        spans = sorted(((k, int(a), int(b)) for k, a, b in (x.split(":") for x in row.spans.split(","))), key=lambda x: (x[1], -x[2]))
        out, at = [], 0
        for k, a, b in spans:
            if a >= at:
                out += [text[at:a], f"<{k.upper()}>"]
            at = max(at, b)
        assert masked.text == "".join(out) + text[at:]
    assert took[1] < 8 * took[0] + 10, took


def test_running_values_in_blocks_of_blocks(spark):
    random.seed(36)
    for n in (1, 127, 128, 129, 16_384, 16_385, 40_000):
        x = [random.randrange(50) for _ in range(n)]
        df = spark.createDataFrame([(x, x)], "up array<int>, most array<int>")
        row = pii._running(pii._running(df, ["up"], "$s + $x"), ["most"], "greatest($s, $x)").first()
        assert len(row.up) == len(row.most) == n
        total = most = 0
        for k, v in enumerate(x):
            total, most = total + v, max(most, v)
            assert (row.up[k], row.most[k]) == (total, most)
