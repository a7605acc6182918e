"""Personal data: fixed patterns, and terms that reveal them, all with DataFrame functions.

Base spans are emails, ip addresses, card numbers and phone numbers, each kind's matches leftmost
and without overlap. On top of them come terms (runs of letters and digits) that give a protected
value away. Corpus counts estimate how much: with n(c, t) the occurrences of term t within
`WINDOW` terms of value c, on its line or beyond but not past another value, n(c) and n(t) those of
each, and N all terms,

    PMI(c; t) = log2(n(c, t) N d / (2 WINDOW n(c) n(t))),    IC(c) = log2(N / (2 WINDOW n(c))).

d = 1 - DISCOUNT / m smooths counts from only m different texts, so that a pair seen once needs a
rarer term and value than one seen often. A term discloses the share PMI / IC of what identifies c.
From `REMOVE` on it is removed, from `GENERALISE` on it is replaced by its class: at every place
outside the base spans, in all texts that hold the value. In a text without the value that takes
more: n(c, t) / n(t) above `ELSEWHERE`, so that the term mostly stands next to the value. Else a term
that is met near a value once, and a few times elsewhere, would be taken out of texts that have
nothing to do with it, the more of them the larger the corpus.

A null text is an empty one, without spans. Copies of a text get the same spans and count as
support once; repeated rows are kept. An empty table gives an empty result. Other columns are not
read by `find`; `sanitise` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.scratch import scratch_dir

WINDOW = 8
DISCOUNT = 0.75
GENERALISE = 0.8
REMOVE = 0.95
ELSEWHERE = 0.5
_SMALL = 1_000_000           # terms that may be broadcast, once counted
_TEXTS_A_TASK = 256          # texts with spans, whose terms are taken apart span by span

# Kinds in order. The patterns are those of the contract, with possessive runs and a start that is
# not inside a run that has failed: that changes no match, and keeps long texts linear.
KINDS = ("email", "ip", "card", "phone")
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
             r"(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Every text with a match has one of these, which are found faster.
_HINTS = {"email": "@", "ip": "[0-9][.][0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "[+][0-9]"}
_TERM = r"[\p{L}\p{N}]+"
_NO_TERM = r"[^\p{L}\p{N}]+"
_SPAN = "struct<start:bigint,kind:int,end:bigint,value:string>"
_CHUNK = 256


def running_sum(values: Column) -> Column:
    """Sums of the elements before each one, of an array of bigint.

    Chunk by chunk, as an array that grows by one element at a time is copied each time.
    """
    zero = F.lit(0).cast("bigint")
    none = F.array().cast("array<bigint>")
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _CHUNK).cast("int")),
        lambda c: F.slice(values, c * _CHUNK + 1, F.lit(_CHUNK)))
    state = F.struct(zero.alias("sum"), none.alias("out"))
    within = F.transform(chunks, lambda chunk: F.aggregate(chunk, state, lambda s, v: F.struct(
        (s["sum"] + v).alias("sum"), F.concat(s["out"], F.array(s["sum"])).alias("out"))))
    whole = F.struct(zero.alias("sum"), F.array().cast("array<array<bigint>>").alias("out"))
    placed = F.aggregate(within, whole, lambda s, c: F.struct(
        (s["sum"] + c["sum"]).alias("sum"),
        F.concat(s["out"], F.array(F.transform(c["out"], lambda v: v + s["sum"]))).alias("out")))
    return F.when(F.size(values) > 0, F.flatten(placed["out"])).otherwise(none)


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, match) in code points: the pieces between matches tell the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p).cast("bigint"))
    gaps = F.slice(gaps, F.lit(1), F.size(found))
    steps = F.zip_with(gaps, found, lambda g, m: g + F.char_length(m))
    starts = F.zip_with(running_sum(steps), gaps, lambda before, g: before + g)
    return F.zip_with(starts, found, lambda s, m: F.struct(s.alias("start"), m.alias("match")))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 1, F.element_at(F.array(*(F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))),
                                 d.try_cast("int") + 1)).otherwise(d.try_cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(parts, lambda p: (F.char_length(p) <= 3)
                        & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = _digits(match)
        return F.char_length(digits).between(14, 19) & _luhn(digits)
    if kind == "phone":
        return F.char_length(_digits(match)).between(10, 15)
    return F.lit(True)


def _value(kind: str, match: Column) -> Column:
    """What is protected, however it is written."""
    plain = {"email": F.lower, "card": _digits, "phone": _digits}.get(kind, lambda m: m)
    return F.concat(F.lit(f"{kind}:"), plain(match))


def _spans_of(text: Column, kind: str) -> Column:
    found = F.filter(_matches(text, _PATTERNS[kind]), lambda m: _valid(kind, m["match"]))
    spans = F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
        (m["start"] + F.char_length(m["match"])).alias("end"),
        _value(kind, m["match"]).alias("value")))
    return F.when(F.rlike(text, F.lit(_HINTS[kind])), spans).otherwise(
        F.array().cast(f"array<{_SPAN}>"))


def base_spans(text: Column) -> Column:
    """Spans (start, kind, end, value) of fixed patterns, by start and kind."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*(_spans_of(text, kind) for kind in KINDS)))


def _terms(text: Column, offset: Column) -> Column:
    """Array of (start, end, term) of a stretch of text that begins at an offset."""
    return F.transform(_matches(text, _TERM), lambda m: F.struct(
        (m["start"] + offset).alias("start"),
        (m["start"] + offset + F.char_length(m["match"])).alias("end"),
        F.lower(m["match"]).alias("term")))


def _contexts(text: Column, spans: Column) -> Column:
    """Terms near each span: array of (value, start, end, term).

    The text between two neighbouring spans is taken apart once for each of them.
    """
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["end"]))
    size = F.char_length(text).cast("bigint")
    starts = F.concat(F.transform(F.slice(spans, F.lit(2), F.greatest(
        F.size(spans) - 1, F.lit(0))), lambda s: s["start"]), F.array(size))
    places = F.zip_with(F.slice(ends, F.lit(1), F.size(spans)), starts, lambda since, until:
                        F.struct(since.alias("since"), until.alias("until")))
    places = F.zip_with(spans, places, lambda span, place: F.struct(
        span.alias("span"), place["since"].alias("since"), place["until"].alias("until")))

    def between(begin, end):
        return F.substr(text, (begin + 1).cast("int"), F.greatest(
            end - begin, F.lit(0)).cast("int"))

    def near(place):
        span = place["span"]
        before = _terms(between(place["since"], span["start"]), place["since"])
        after = _terms(between(span["end"], place["until"]), span["end"])
        last = F.slice(before, F.greatest(F.size(before) - WINDOW, F.lit(0)) + 1, F.lit(WINDOW))
        return F.transform(F.concat(last, F.slice(after, 1, WINDOW)), lambda t: F.struct(
            span["value"].alias("value"), t["start"].alias("start"), t["end"].alias("end"),
            t["term"].alias("term")))
    return F.flatten(F.transform(places, near))


def _outside(texts: DataFrame) -> DataFrame:
    """key, start, end and term of all terms outside the spans of (key, text, spans).

    Arrays are columns of their own, as an expression within a lambda is computed for each element.
    """
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("spans", lambda s: s["end"]))
    starts = F.concat(F.transform("spans", lambda s: s["start"]),
                      F.array(F.char_length("text").cast("bigint")))
    gaps = texts.select("key", "text", ends.alias("ends"), starts.alias("starts")).select(
        "key", "text", F.inline(F.transform("starts", lambda until, i: F.struct(
            F.array_max(F.slice("ends", F.lit(1), i + 1)).alias("since"), until.alias("until")))))
    pieces = gaps.where("until > since").select("key", "since", F.substr(
        F.col("text"), (F.col("since") + 1).cast("int"),
        (F.col("until") - F.col("since")).cast("int")).alias("piece"))
    found = pieces.select("key", "since", F.regexp_extract_all(
        "piece", F.lit(_TERM), F.lit(0)).alias("found"), F.split("piece", _TERM, -1).alias("rest"))
    sized = found.select("key", "since", "found", F.transform(
        F.slice("rest", F.lit(1), F.size("found")),
        lambda r: F.char_length(r).cast("bigint")).alias("rest"))
    sized = sized.select("key", "since", "found", "rest", F.zip_with(
        "rest", "found", lambda r, t: r + F.char_length(t)).alias("steps"))
    placed = sized.select("key", "found", F.zip_with(
        running_sum(F.col("steps")), "rest", lambda before, r: before + r).alias("starts"), "since")
    return placed.select("key", "since", F.inline(F.zip_with("starts", "found", lambda s, t: F.struct(
        s.alias("at"), t.alias("word"))))).select(
            "key", (F.col("since") + F.col("at")).alias("start"),
            (F.col("since") + F.col("at") + F.char_length("word")).alias("end"),
            F.lower("word").alias("term"))


def _text_key(text: Column, doc_id: Column) -> Column:
    """Names a text; empty ones get names that match nothing, and are spread."""
    return F.when(F.coalesce(text, F.lit("")) != "", F.md5(F.encode(text, "utf-8"))).otherwise(
        F.hex(F.xxhash64(doc_id)))


def disclosing_terms(docs: DataFrame, *, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """key (of a text) and its terms (start, end, removed) that disclose a value of any text."""
    spark = docs.sparkSession
    folder = scratch_dir(spark, "pii")

    def store(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    text = F.col(text_col)
    found = docs.select(text.alias("text"), base_spans(text).alias("spans")).where(
        F.size("spans") > 0)
    texts = found.groupBy(F.md5(F.encode("text", "utf-8")).alias("key")).agg(
        F.count("*").alias("copies"), F.first("text").alias("text"))
    texts = store(texts.withColumn("spans", base_spans(F.col("text"))), "texts")
    tasks = -(-texts.count() // _TEXTS_A_TASK)
    near = texts.repartition(max(1, tasks)).select(
        "key", "copies", F.inline(_contexts(F.col("text"), F.col("spans"))))
    values = texts.select("copies", F.explode("spans").alias("span")).groupBy(
        F.col("span.value").alias("value")).agg(F.sum("copies").alias("n_value"))
    pairs = (near.groupBy("value", "term", "key").agg(
        F.count("*").alias("times"), F.first("copies").alias("copies"))
        .groupBy("value", "term").agg(F.sum(F.col("times") * F.col("copies")).alias("n_pair"),
                                      F.count("*").alias("texts")))
    pairs = store(pairs, "pairs")
    # Every term of every text; splitting leaves an empty string where a text begins or ends. The
    # terms that are not asked for count only towards the total.
    terms = docs.select(F.explode(F.split(F.lower(text), _NO_TERM)).alias("term")).where(
        "term <> ''")
    wanted = store(pairs.select("term").distinct(), "wanted")
    if wanted.count() <= _SMALL:
        asked = F.broadcast(wanted.withColumn("asked", F.lit(True)))
        terms = terms.join(asked, "term", "left").select(F.when(F.col("asked"), F.col(
            "term")).alias("term"))
    counts = store(terms.groupBy("term").agg(F.count("*").alias("n_term")), "terms")
    total = counts.agg(F.sum("n_term").alias("n")).first().n or 0
    known = (pairs.join(store(values, "values"), "value").join(counts, "term")
             .withColumn("room", F.lit(float(total)) / (2 * WINDOW)))
    content = F.log2(F.col("room") / F.col("n_value"))
    smooth = 1 - DISCOUNT / F.col("texts")
    pmi = F.log2(F.col("n_pair") * smooth * F.col("room") / (F.col("n_value") * F.col("n_term")))
    share = F.when(content > 0, pmi / content)
    risky = store(known.withColumn("share", share).where(F.col("share") >= GENERALISE).select(
        "value", "term", (F.col("share") >= REMOVE).alias("removed"),
        (F.col("n_pair") > ELSEWHERE * F.col("n_term")).alias("elsewhere")), "risky")
    mostly = store(risky.where("elsewhere").groupBy("term").agg(
        F.max("removed").alias("removed")), "mostly")
    if mostly.count() <= _SMALL:
        mostly = F.broadcast(mostly)
    # Texts without spans that name a term of those; texts with spans are stored.
    key = _text_key(text, F.col(id_col))
    naming = docs.select(key.alias("key"), F.explode(F.array_distinct(
        F.split(F.lower(text), _NO_TERM))).alias("term"))
    clean = store(naming.join(mostly, "term", "left_semi").select("key").distinct().join(
        texts.select("key"), "key", "left_anti"), "clean")
    clean = docs.select(key.alias("key"), text.alias("text")).join(clean, "key", "left_semi")
    clean = clean.groupBy("key").agg(F.first("text").alias("text")).select(
        "key", "text", F.array().cast(f"array<{_SPAN}>").alias("spans"))
    # One row for each term of a text that is taken out, for any value or for one that it holds.
    anywhere = _outside(texts.select("key", "text", "spans").union(clean)).join(mostly, "term")
    holds = texts.select("key", F.explode("spans").alias("span")).select(
        "key", F.col("span.value").alias("value")).distinct()
    own = _outside(texts.select("key", "text", "spans").repartition(max(1, tasks))).join(
        risky.where("not elsewhere").select("value", "term", "removed"), "term").join(
            holds, ["key", "value"])
    columns = ["key", "start", "end", "removed"]
    out = anywhere.select(*columns).union(own.select(*columns)).groupBy("key", "start", "end").agg(
        F.max("removed").alias("removed"))
    return store(out.groupBy("key").agg(F.array_sort(F.collect_list(
        F.struct("start", "end", "removed"))).alias("terms")), "disclosing")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, counts by kind, and base and all spans as text.

    Returned are n_email, n_ip, n_card, n_phone, base_spans and spans (kind:start:end, by start
    and kind, comma-joined; code points, end exclusive).
    """
    terms = disclosing_terms(docs, id_col=id_col, text_col=text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("_text"), base_spans(text).alias("_base"))
    rows = rows.select(id_col, "_base", _text_key(
        F.col("_text"), F.col(id_col)).alias("key"))
    joined = rows.join(terms, "key", "left")
    names = F.array(*(F.lit(k) for k in (*KINDS, "term")))
    base = F.transform("_base", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("order"), s["end"].alias("end")))
    found = F.transform(F.coalesce("terms", F.array().cast(
        "array<struct<start:bigint,end:bigint,removed:boolean>>")), lambda t: F.struct(
            t["start"].alias("start"), F.lit(len(KINDS)).alias("order"), t["end"].alias("end")))

    def named(spans):
        return _joined(F.transform(F.array_sort(spans), lambda s: F.struct(
            s["start"].alias("start"), F.element_at(names, s["order"] + 1).alias("kind"),
            s["end"].alias("end"))))
    kinds = F.transform("_base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, n))).cast("bigint").alias(f"n_{k}")
              for n, k in enumerate(KINDS)]
    return joined.select(id_col, *counts, named(base).alias("base_spans"),
                         named(F.concat(base, found)).alias("spans"))


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             length_col: str | None = None) -> DataFrame:
    """The rows of `docs` with base spans replaced by their kind, and disclosing terms by their
    class or by nothing. length_col: a column that is set to the new text's length.

    Null texts stay null. Spans that overlap are replaced as one, by the first of them.
    """
    columns = docs.columns
    terms = disclosing_terms(docs, id_col=id_col, text_col=text_col)
    rows = docs.select(F.struct("*").alias("_row")).select(
        "_row", base_spans(F.col(f"_row.{text_col}")).alias("_base"))
    rows = rows.withColumn("key", _text_key(
        F.col(f"_row.{text_col}"), F.col(f"_row.{id_col}")))
    joined = rows.join(terms, "key", "left")
    text = F.col(f"_row.{text_col}")
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def part(begin, end):
        return F.substr(text, (begin + 1).cast("int"), F.greatest(
            end - begin, F.lit(0)).cast("int"))
    edits = F.array_sort(F.concat(
        F.transform("_base", lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.element_at(names, s["kind"] + 1).alias("by"))),
        F.transform(F.coalesce("terms", F.array().cast(
            "array<struct<start:bigint,end:bigint,removed:boolean>>")), lambda t: F.struct(
                t["start"].alias("start"), t["end"].alias("end"),
                F.when(t["removed"], F.lit("")).when(
                    F.rlike(part(t["start"], t["end"]), F.lit(r"^\p{N}+$")), F.lit("[NUMBER]"))
                .otherwise(F.lit("[WORD]")).alias("by")))))
    # Each edit gives what stands before it and its replacement; one inside an earlier edit, none.
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(edits, lambda e: e["end"]))
    reach = F.aggregate(ends, F.lit(0).cast("bigint"), lambda m, e: F.greatest(m, e))
    before = F.transform(F.sequence(F.lit(1), F.size(edits)), lambda i: F.struct(
        F.element_at(edits, i).alias("edit"),
        F.array_max(F.slice(ends, F.lit(1), i)).alias("since")))
    parts = F.transform(before, lambda b: F.when(
        b["edit"]["start"] >= b["since"],
        F.concat(part(b["since"], b["edit"]["start"]), b["edit"]["by"])).otherwise(F.lit("")))
    clean = F.when(F.size(edits) > 0, F.concat(
        F.array_join(parts, ""), F.substr(text, (reach + 1).cast("int")))).otherwise(text)
    out = joined.select(F.col("_row"), clean.alias("_clean"))
    return out.select(*(
        F.col("_clean").alias(c) if c == text_col else
        F.char_length("_clean").cast(dict(docs.dtypes)[c]).alias(c) if c == length_col else
        F.col(f"_row.{c}").alias(c) for c in columns))
