"""Base spans against Python's regular expressions; the test battery against random and plain strings."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from waybill.llm import queries, secrets

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


TEXTS = [
    None, "", "é🙂 token=token:abcdef Secret : \"abcdefgh\"", "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 12 + " AKIA123",
    "0f" * 12 + "x" + "0f" * 11 + "X" + "ab" * 40, "ſecret=abcdefg toKen=abcdefg API_KEY='x/y+z=='", "password = = abcdefg",
    "apikey:" + "0123456789abcdef" * 3, "token=" + "a" * 50_000, "secret=ab secret=abcdef", "x" * 100_000,
]


def test_base_spans(spark, docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, TEXTS[2]), (2, TEXTS[2])]
    table = docs(rows, extra="spans_of")
    got = secrets.find(table).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append([(s["start"], s["kind"], s["end"]) for s in r["spans"] if s["kind"] < 3])
    for i, t in rows:
        assert base(t) in by[i]
    assert secrets.find(table.limit(0)).count() == 0


def test_random_strings_are_found_and_plain_ones_are_not(spark, docs):
    rng = random.Random(5)
    rows, kinds = [], {}
    letters = "etaoinshrdlu"
    for i in range(400):
        alphabet = secrets.ENCODINGS[rng.choice([6, 7, 8])][2]
        plain = i % 2
        token = (
            "".join(rng.choice(letters[:6]) if rng.random() < 0.9 else "1" for _ in range(40)) + "1" if plain
            else "".join(rng.choice(alphabet) for _ in range(40))
        )
        rows.append((i, f"see {token} there"))
        kinds[i] = plain
    found = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == 3] for r in secrets.find(docs(rows)).collect()}
    hit = [bool(found[i]) for i in range(400)]
    assert sum(h for i, h in enumerate(hit) if not kinds[i]) >= 0.85 * 200
    assert sum(h for i, h in enumerate(hit) if kinds[i]) == 0
    one = next(i for i in range(400) if found[i])
    assert found[one][0]["start"] == 4


def test_strings_without_digits_are_judged(spark, docs):
    """Random ones of 16 to 24 characters are found, words and paths of such lengths mostly aren't."""
    rng = random.Random(8)
    alphabets = [secrets.UPPER + secrets.LOWER, secrets.UPPER + secrets.LOWER + "+/", secrets.UPPER, secrets.LOWER]
    words = "the river house walks under green light often slowly between seven little stones".split()
    rows = [(i, "see " + "".join(rng.choice(alphabets[i % 4]) for _ in range(rng.randrange(16, 25))) + " there") for i in range(800)]
    rows += [(800 + i, "see " + "-/"[i % 2].join(rng.sample(words, 5)) + " there") for i in range(400)]
    rows += [(1200 + i, "see " + "".join(w.title() for w in rng.sample(words, 4)) + " there") for i in range(400)]
    found = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == 3] for r in secrets.find(docs(rows)).collect()}
    for kind in range(4):
        assert sum(bool(found[i]) for i in range(kind, 800, 4)) >= 0.85 * 200
    assert sum(bool(found[i]) for i in range(800, 1600)) <= 0.05 * 800


def test_masking(spark):
    text = "é token=abcdef0 and " + "0f" * 15 + " end"
    table = spark.createDataFrame([(1, text), (2, "nothing"), (3, "")], "doc_id long, text string")
    found = secrets.find(table, keep=["doc_id", "text"])
    got = {r[0]: r[1] for r in found.select("doc_id", secrets.masked(F.col("text"), F.col("spans"))).collect()}
    assert got == {1: "é [secret] and [secret] end", 2: "nothing", 3: ""}


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in queries.read(spark, sf_dir, "documents").collect()}
    for r in queries.op5_secret_scan(spark, sf_dir).collect():
        want = base(texts[r["doc_id"]])
        shown = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, k, _ in want) for n in range(3)]


def plainly_masked(text, spans, mark="[secret]"):
    out, pos = [], 0
    for start, end in spans:
        if start >= pos:
            out += [text[pos:start], mark]
        pos = max(pos, end)
    return "".join([*out, text[pos:]])


def test_masking_across_stretches(spark):
    """Spans within, over and right at the edges of the stretches that are masked by themselves."""
    rng = random.Random(7)
    text = "".join(rng.choice("ab é🙂") for _ in range(3 * secrets.STRETCH + 17))
    size = secrets.STRETCH
    cases = [
        [], [(0, 5)], [(size - 3, size + 4)], [(size - 2, 2 * size + 5), (size, size + 9)], [(size, 2 * size)], [(len(text) - 4, len(text))],
        sorted((s, s + rng.randrange(1, 300)) for s in rng.sample(range(len(text) - 300), 200)),
    ]
    rows = spark.createDataFrame(
        [(i, text, [{"start": s, "end": e} for s, e in c]) for i, c in enumerate(cases)],
        "i int, text string, spans array<struct<start:int,end:int>>",
    )
    got = dict(rows.select("i", secrets.masked(F.col("text"), F.col("spans"))).collect())
    assert got == {i: plainly_masked(text, c) for i, c in enumerate(cases)}


def test_a_megabyte_of_matches_takes_seconds(spark, docs):
    text = " ".join(f"token=abc{i:06}" for i in range(64_000))
    table = docs([(1, text)])
    secrets.find(docs([(1, "token=abcdef")])).collect()
    begun = time.monotonic()
    found = secrets.find(table, keep=["doc_id", "text"])
    row = found.select("spans", secrets.masked(F.col("text"), F.col("spans")).alias("masked")).first()
    assert time.monotonic() - begun < 60
    assert [(s["start"], s["end"]) for s in row["spans"] if s["kind"] == 0] == [(s, e) for s, _, e in base(text)]
    assert row["masked"] == " ".join(["[secret]"] * 64_000)


def test_columns_of_any_name(spark):
    table = spark.createDataFrame([(1, "token=abcdef", 7, 8)], "doc_id long, text string, found_hex int, kept_0 int")
    row = secrets.find(table, keep=table.columns).first()
    assert (row["found_hex"], row["kept_0"], len(row["spans"])) == (7, 8, 1)
    assert queries.op5_secret_scan(spark, "/root/testdata/sf0.001").columns[:6] == [
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans",
    ]


def test_the_battery_by_hand(spark, docs):
    """Chi-squared, runs and serial correlation of one string each, and the step-up rule, recomputed."""
    rows = [(i, f"see {t} there") for i, t in enumerate(battery_strings())]
    scanned = secrets.scan(docs(rows), ["doc_id"]).collect()
    tried = {}
    for r in scanned:
        for c in r["found_candidates"]:
            tried.setdefault((c["encoding"], c["band"]), []).append(c["step"])
    limits = {}
    for key, steps in tried.items():
        good = [
            s for s in set(steps)
            if 10 ** (-s / secrets.P_STEPS) <= secrets.LEVEL * sum(x >= s for x in steps) / len(steps)
        ]
        if good:
            limits[key] = min(good)
    found = secrets.limits(secrets.scan(docs(rows), ["doc_id"])).collect()
    assert {(r["encoding"], r["band"]): r["limit"] for r in found} == limits
    spans = {r["doc_id"]: {s["start"] for s in r["spans"] if s["kind"] == 3} for r in secrets.find(docs(rows)).collect()}
    for r in scanned:
        held = {
            c["start"] for c in r["found_candidates"]
            if c["step"] < limits.get((c["encoding"], c["band"]), secrets.P_LOWEST + 1)
        }
        plain = {(s["start"], s["end"]) for k in ("assign", "access", "hex") for s in r[f"found_{k}"]}
        ends = {c["start"]: c["end"] for c in r["found_candidates"]}
        held = {s for s in held if not any(a < ends[s] and s < b for a, b in plain)}
        assert spans[r["kept_0"]] == held


def battery_strings():
    rng = random.Random(11)
    out = []
    for alphabet in ("0123456789", "abcdef0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", secrets.UPPER + secrets.LOWER + secrets.DIGITS):
        for n in (16, 24, 40, 90):
            out += ["".join(rng.choice(alphabet) for _ in range(n)) for _ in range(3)]
            out += [alphabet[i] * (n // 2) + "1" + alphabet[-1] * (n // 2) for i in (0, 3)]
            out.append("".join(alphabet[i % 5] for i in range(n)) + "1")
    return out
