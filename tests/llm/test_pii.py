import hashlib
import random
import re

import pytest

from pairloom.llm import pii
from pairloom.llm.queries import QUERIES

# The contract's patterns as they stand, for the brute-force version.
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += digit if i % 2 == 0 else sum(divmod(2 * digit, 10))
    return total % 10 == 0


def base(text):
    spans = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            fits = {"email": True, "phone": 10 <= len(digits) <= 15,
                    "card": 14 <= len(digits) <= 19 and luhn(digits),
                    "ip": kind != "ip" or all(int(p) <= 255 for p in match[0].split("."))}[kind]
            if fits:
                spans.append((match.start(), order, kind, match.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans))


TEXTS = ["a@b.c_x@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 00000000001.2.3.4 9999999999999999999.1.1.1",
         "+1 (017) 555-7713 +12345678901234567890 ++1-2-3-4-5-6-7-8-9-0 +1.2",
         "4111 1111 1111 1111 4111-1111-1111-1111x 41111111111111111", "é🙂 a.b@c.de é 🙂x@y.z",
         "a" * 3000 + "@b.co", "@@a@b@c.d.e", "user@@host.com a@b a@b. a@.c a@-.-", None, "",
         "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8", "0" * 20_000, "a.b@c." + "d." * 2000 + "e",
         "1 " * 10_000, "." * 1000 + "@x.y" + "+1" * 50, "%@-.-%@-.-", "x@y.z " * 700,
         "+1 (017) 555-7713\n4111111111111111\n10.0.0.1"]


@pytest.fixture
def texts(spark, tmp_path):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    frame.write.parquet(str(tmp_path / "texts"))
    return spark.read.parquet(str(tmp_path / "texts"))


def test_base_spans_of_odd_texts(texts):
    for row in pii.find(texts).collect():
        assert row.base_spans == base(TEXTS[row.doc_id]), row.doc_id


def test_query(spark, sf_dir, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for row in QUERIES["op6_pii"](spark, sf_dir).collect():
        spans = base(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        kept = [s for s in row.spans.split(",") if s and not s.startswith("term:")]
        assert ",".join(kept) == spans
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(s.startswith(k) for s in kept) for k in PATTERNS]


def test_running_sum(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        row = spark.range(1).selectExpr(
            f"transform(slice(sequence(0, {n}), 1, {n}), x -> CAST(x AS bigint)) AS v").select(
                pii.running_sum(pii.F.col("v")).alias("s")).first()
        assert row.s == [i * (i - 1) // 2 for i in range(n)]


@pytest.fixture
def secrets(spark, tmp_path):
    """Six texts in which `zorgle` stands by one address only, `common` everywhere."""
    rows = [(i, f"common x{i} zorgle kid@mail.com common end{i}") for i in range(6)]
    rows += [(100 + i, f"common common clean text {i} common") for i in range(400)]
    rows += [(600 + i, "only copies quux near other@mail.com here") for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.write.parquet(str(tmp_path / "secrets"))
    return spark.read.parquet(str(tmp_path / "secrets"))


def test_disclosing_terms(secrets):
    spans = {r.doc_id: r.spans for r in pii.find(secrets).collect()}
    for i in range(6):
        assert spans[i] == "term:10:16,email:17:29"
    # Clean texts stay, and copies of one text are no evidence.
    assert {s for i, s in spans.items() if 100 <= i < 600} == {""}
    assert {s for i, s in spans.items() if i >= 600} == {"email:22:36"}


def test_threshold_formula(secrets):
    """PMI over IC, counted by hand."""
    from math import log2
    texts = [r.text for r in secrets.collect()]
    terms = [t for text in texts for t in re.findall(r"[^\W_]+", text.lower())]
    room = len(terms) / (2 * pii.WINDOW)
    content = log2(room / 6)
    share = {t: log2(pairs * room / (6 * terms.count(t))) / content
             for t, pairs in (("zorgle", 6), ("common", 12))}
    assert share["zorgle"] >= pii.REMOVE and share["common"] < pii.GENERALISE


def test_sanitised_texts(secrets):
    texts = {r.doc_id: r.text for r in pii.sanitise(secrets).collect()}
    assert texts[3] == "common x3  [EMAIL] common end3"
    assert texts[100] == "common common clean text 0 common"
    assert texts[600] == "only copies quux near [EMAIL] here"


def test_sanitised_texts_hold_no_spans(texts):
    for row in pii.sanitise(texts).collect():
        assert base(row.text) == "" and (row.text is None) == (TEXTS[row.doc_id] is None)
        if not base(TEXTS[row.doc_id]):
            assert row.text == TEXTS[row.doc_id]


def test_awkward_rows(awkward):
    rows = awkward.collect()
    found = pii.find(awkward).collect()
    assert sorted(r.base_spans for r in found) == sorted(base(r.text) for r in rows)
    clean = pii.sanitise(awkward, length_col="n_chars")
    assert clean.schema.names == awkward.schema.names and clean.count() == len(rows)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in clean.collect())
    assert pii.find(awkward.where("false")).count() == 0
    assert pii.sanitise(awkward.where("false")).count() == 0


def test_main_path_is_native(secrets):
    plan = pii.find(secrets)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_terms_are_taken_out_wherever_they_stand(spark, tmp_path):
    """Far from the value, behind another span, and in texts without the value."""
    far = " ".join(["common"] * 12)
    rows = [(i, f"common x{i} zorgle kid@mail.com {far}") for i in range(6)]
    rows += [(6, f"kid@mail.com {far} 10.0.0.1 Zorgle"), (7, f"the word zorgle {far}")]
    rows += [(100 + i, f"common common clean text {i} common") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.write.parquet(str(tmp_path / "far"))
    frame = spark.read.parquet(str(tmp_path / "far"))
    spans = {r.doc_id: r.spans for r in pii.find(frame).collect()}
    assert spans[0] == "term:10:16,email:17:29"
    assert spans[6].startswith("email:0:12,ip:") and ",term:" in spans[6]
    assert spans[7] == "term:9:15" and spans[100] == ""
    texts = {r.doc_id: r.text for r in pii.sanitise(frame).collect()}
    assert "orgle" not in texts[6] + texts[7]


def test_rare_values_are_decided(spark, tmp_path):
    """A value of two texts has a term removed; one of a single text has it generalised, as the
    corpus is large enough for its neighbour to be no accident."""
    rows = [(i, f"common zorgle kid@mail.com common {i % 7}") for i in range(2)]
    rows += [(2, "common quux other@mail.com common")]
    rows += [(100 + i, f"common {i % 9} " * 500) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.write.parquet(str(tmp_path / "rare"))
    spans = {r.doc_id: r.spans for r in pii.find(
        spark.read.parquet(str(tmp_path / "rare"))).collect()}
    assert spans[0].startswith("term:7:13,email") and spans[1].startswith("term:7:13,email")
    assert spans[2].startswith("term:7:11,email") and spans[100] == ""


def test_rare_neighbours_stay_where_the_value_is_not(spark, tmp_path):
    """A term near a value once, and elsewhere more often, goes only beside that value."""
    rows = [(i, f"common quux kid@mail.com common {i}") for i in range(2)]
    rows += [(i, f"common quux of {i} common") for i in range(2, 5)]
    rows += [(100 + i, f"common {i % 9} " * 900) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.write.parquet(str(tmp_path / "rare"))
    frame = spark.read.parquet(str(tmp_path / "rare"))
    spans = {r.doc_id: r.spans for r in pii.find(frame).collect()}
    assert spans[0] == spans[1] == "term:7:11,email:12:24"
    assert [spans[i] for i in (2, 3, 4, 100)] == [""] * 4


def plain_terms(texts):
    """Term spans (start, end, removed) of each text, by counting everything."""
    from collections import Counter
    from math import log2
    term = re.compile(r"[^\W_]+")
    copies = Counter(texts)
    total, n_term, n_value = 0, Counter(), Counter()
    n_pair, n_texts, held = Counter(), Counter(), {}
    for text, times in copies.items():
        for m in term.finditer(text):
            n_term[m.group().lower()] += times
            total += times
        spans = [s.split(":") for s in base(text).split(",") if s]
        spans = [(int(a), int(b), f"{k}:{text[int(a):int(b)].lower()}") for k, a, b in spans]
        held[text] = spans
        seen = Counter()
        for i, (a, b, value) in enumerate(spans):
            n_value[value] += times
            since = spans[i - 1][1] if i else 0
            until = spans[i + 1][0] if i + 1 < len(spans) else len(text)
            near = term.findall(text[since:a])[-pii.WINDOW:] + term.findall(
                text[b:until])[:pii.WINDOW]
            seen.update((value, t.lower()) for t in near)
        for pair, n in seen.items():
            n_pair[pair] += n * times
            n_texts[pair] += 1
    room, risky = total / (2 * pii.WINDOW), {}
    for (value, t), n in n_pair.items():
        content = log2(room / n_value[value])
        pmi = log2(n * (1 - pii.DISCOUNT / n_texts[value, t]) * room
                   / (n_value[value] * n_term[t]))
        if content > 0 and pmi / content >= pii.GENERALISE:
            risky[value, t] = (pmi / content >= pii.REMOVE, n > pii.ELSEWHERE * n_term[t])
    out = []
    for text in texts:
        values, found = {v for *_, v in held[text]}, set()
        for m in term.finditer(text):
            if any(a <= m.start() < b for a, b, _ in held[text]):
                continue
            kinds = [removed for (v, t), (removed, elsewhere) in risky.items()
                     if t == m.group().lower() and (elsewhere or v in values)]
            if kinds:
                found.add((m.start(), m.end()))
        out.append(found)
    return out, risky


def test_terms_against_plain_counts(spark, tmp_path):
    rng = random.Random(11)
    words = ["alpha", "beta", "Gamma", "delta", "eps", "zeta"]
    values = ["kid@mail.com", "Other@host.example.org", "10.0.0.1", "ann@mail.com"]
    friends = {v: [f"only{i}", f"mostly{i}"] for i, v in enumerate(values)}
    texts = []
    for i in range(160):
        line = rng.choices(words, k=rng.randrange(4, 30)) + [f"u{i}"]
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            value = rng.choice(values)
            at = rng.randrange(len(line))
            line[at:at] = [rng.choice(friends[value]), value]
        if rng.random() < 0.5:
            line.append(rng.choice(["only0", "mostly1", "mostly2"]))
        texts.append(" ".join(line))
    texts += texts[:10] + [" ".join(rng.choices(words, k=10_000)) for _ in range(30)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    frame.write.parquet(str(tmp_path / "plain"))
    want, risky = plain_terms(texts)
    assert {e for _, e in risky.values()} == {True, False} and any(want)
    for row in pii.find(spark.read.parquet(str(tmp_path / "plain"))).collect():
        found = {tuple(map(int, s.split(":")[1:])) for s in row.spans.split(",")
                 if s.startswith("term:")}
        assert found == want[row.doc_id], texts[row.doc_id]
