"""Personal data: exact patterns as seeds, contexts learned from them, iterated scores. Column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import lower_ascii, stage

# The kinds in their order and what each looks like. The look-behinds only keep the
# search linear (a run of digits or address characters is tried from its start, or from the end
# of the match before it); the matches are the leftmost ones of the plain expressions.
KINDS = ("email", "ip", "card", "phone")
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++\.{_LABEL}(?:[A-Za-z0-9.-](?<!\.(?!{_LABEL})))*+",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[0-9\x20-](?<![\x20-](?![0-9])))++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a match to be possible at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"

ROUNDS = 3
MIN_SEEDS = 3
MIN_SCORE = 0.8
MIN_CHARS = 5
CONTEXT = 200
BLOCK = 256
_SPAN = "array<struct<k:int,s:int,e:int>>"
_MARK = "array<struct<k:int,s:int,e:int,v:string,left:string,shape:string>>"


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, though ``use`` names it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def found(text: Column, pattern: str) -> Column:
    """array<struct<seen, v, s>>: matches with the CONTEXT characters before each in the text and their start.

    Matches are worked through in blocks, each begun with the length and the end of the text before it, so that
    no list grows by one match at a time; a block of matches is longer than CONTEXT.
    """
    gaps, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(g.alias("before"), m.alias("v")))
    return bound(pairs, _in_blocks)


def _in_blocks(pairs: Column) -> Column:
    empty = F.array().cast("array<struct<seen:string,v:string,s:int>>")
    last = lambda *parts: F.right(F.concat(*parts), F.lit(CONTEXT))
    length = lambda p: F.length(p["before"]) + F.length(p["v"])
    step = lambda acc, p: F.struct(
        (acc["at"] + length(p)).alias("at"), last(acc["tail"], p["before"], p["v"]).alias("tail"),
        F.array_append(acc["out"], F.struct(
            last(acc["tail"], p["before"]).alias("seen"), p["v"].alias("v"), (acc["at"] + F.length(p["before"])).alias("s")
        )).alias("out"),
    )
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(pairs) / BLOCK).cast("int") - 1))
    blocks = F.transform(numbers, lambda k: F.slice(pairs, k * BLOCK + 1, F.lit(BLOCK)))
    text = lambda own: F.array_join(F.transform(own, lambda p: F.concat(p["before"], p["v"])), "")
    told = F.transform(blocks, lambda own: F.struct(
        own.alias("own"), F.aggregate(own, F.lit(0), lambda n, p: n + length(p)).alias("chars"), F.right(text(own), F.lit(CONTEXT)).alias("end")
    ))

    def work(told: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(told, zero, lambda acc, b: F.struct(
            (acc["at"] + b["chars"]).alias("at"), F.array_append(acc["starts"], acc["at"]).alias("starts")
        ))["starts"]
        ends = F.transform(told, lambda b: b["end"])
        before = F.concat(F.array(F.lit("")), ends)
        joined = F.arrays_zip(F.transform(told, lambda b: b["own"]).alias("own"), starts.alias("at"), F.slice(before, 1, F.size(told)).alias("tail"))
        return F.flatten(F.transform(joined, lambda b: F.aggregate(
            b["own"], F.struct(b["at"].alias("at"), b["tail"].alias("tail"), empty.alias("out")), step
        )["out"]))

    return F.when(F.size(pairs) > 0, bound(told, work)).otherwise(empty)


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check sum of a digit string is right."""
    def term(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + term(i)) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    n = F.length(_digits(v))
    if kind == "ip":
        return F.forall(F.split(v, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
            F.split(v, r"\."), lambda p: F.coalesce(F.substring(F.concat(F.lit("0"), F.ltrim(p, F.lit("0"))), 1, 4).try_cast("int"), F.lit(999)) <= 255
        )
    if kind == "card":
        return F.when(n.between(13, 19), luhn(_digits(v))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _left(seen: Column) -> Column:
    """The two words before, or what there is at the start of a text; punctuation right before the match is none."""
    bare = F.regexp_replace(seen, r"(?<!\S)[^\s\p{L}\p{N}+]++\z", "")
    two = F.regexp_extract(bare, r"(?<!\S)((?:\S++\s++)?\S++)\s*+\z", 1)
    return lower_ascii(F.regexp_replace(two, r"\s+", " "))


def _shape(v: Column) -> Column:
    for run, sign in (("[0-9]+", "9"), (r"\p{Lu}+", "A"), (r"\p{Ll}+", "a"), (r"\s+", " ")):
        v = F.regexp_replace(v, run, sign)
    return F.substring(v, 1, 24)


def _mark(k: Column, s: Column, v: Column, seen: Column) -> Column:
    return F.struct(
        k.cast("int").alias("k"), s.cast("int").alias("s"), (s + F.length(v)).cast("int").alias("e"), v.alias("v"),
        _left(seen).alias("left"), _shape(v).alias("shape"),
    )


def marks(text: Column) -> Column:
    """array<struct<k, s, e, v, left, shape>>: the base spans, kinds in order, then starts, and after them what
    may be one (k is null); code points, end exclusive."""
    return F.concat(*(_marks_of(text, k, kind) for k, kind in enumerate(KINDS)), candidates(text))


def _marks_of(text: Column, k: int, kind: str) -> Column:
    """The valid matches of a kind, and those of several words that fail its check, with k null."""
    judged = F.transform(found(text, PATTERNS[kind]), lambda m: F.struct(m.alias("m"), F.coalesce(_valid(kind, m["v"]), F.lit(False)).alias("ok")))
    group = lambda x: F.contains(x["m"]["v"], F.lit(" ")) & (F.length(x["m"]["v"]) >= MIN_CHARS)
    listed = F.transform(F.filter(judged, lambda x: x["ok"] | group(x)), lambda x: _mark(
        F.when(x["ok"], F.lit(k)), x["m"]["s"], x["m"]["v"], x["m"]["seen"]
    ))
    hint = F.contains(text, F.lit("@")) if kind == "email" else F.rlike(text, F.lit(HINTS[kind]))
    return F.when(hint, listed).otherwise(F.array().cast(_MARK))


def candidates(text: Column) -> Column:
    """array<struct<k, s, e, v, left, shape>>: words with a digit or @, without outer punctuation; k is null.

    Shapes of all kinds hold a digit or @, so no other word can have one."""
    def describe(m: Column) -> Column:
        core = F.regexp_extract(m["v"], r"[\p{L}\p{N}+](?:.*[\p{L}\p{N}])?", 0)
        lead = F.length(F.regexp_extract(m["v"], r"^[^\p{L}\p{N}+]*", 0))
        return _mark(F.lit(None), m["s"] + lead, core, m["seen"])

    wanted = lambda c: (F.length(c["v"]) >= MIN_CHARS) & F.rlike(c["v"], F.lit("[0-9@]"))
    listed = F.filter(F.transform(found(text, TOKEN), describe), wanted)
    return F.when(F.rlike(text, F.lit("[0-9@]")), listed).otherwise(F.array().cast(_MARK))


def spans_text(spans: Column, names: list[str]) -> Column:
    """``kind:start:end``, comma-joined."""
    label = F.array(*[F.lit(n) for n in names])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(label, s["k"]), s["s"].cast("string"), s["e"].cast("string")
    )))


def learn(occurrences: DataFrame, rounds: int, min_seeds: int, min_score: float) -> DataFrame:
    """(pattern, kind, score) of the trusted contexts.

    ``occurrences`` has pattern, v and kind (null if no seed covers it). An instance is a
    value; seeds score 1. A pattern scores the sum of its instances' scores over the number of its
    instances plus one; other instances score 1 - product (1 - score) over their patterns. After
    ``rounds`` such passes over the graph, patterns count that score ``min_score`` and held
    ``min_seeds`` different seeds. Every step is a sum per key over distinct edges.
    """
    edges = stage(occurrences.select("pattern", "v").distinct(), "pii-edges")
    seeds = stage(occurrences.where("kind is not null").select("v", "kind").distinct(), "pii-seeds")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    held = edges.join(seeds, "v").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") >= min_seeds)
    open_ = stage(held.join(sizes, "pattern"), "pii-patterns")
    instances = seeds.withColumn("score", F.lit(1.0))
    scored = None
    for _ in range(rounds):
        sums = edges.join(instances, "v").groupBy("pattern", "kind").agg(F.sum("score").alias("total"))
        scored = stage(open_.join(sums, ["pattern", "kind"]).select(
            "pattern", "kind", F.round(F.least(F.col("total") / (F.col("n") + 1), F.lit(0.999999)), 9).alias("score")
        ), "pii-scores")
        reached = edges.join(scored, "pattern").groupBy("v", "kind").agg(F.sum(F.log(1 - F.col("score"))).alias("l"))
        instances = seeds.withColumn("score", F.lit(1.0)).unionByName(
            reached.join(seeds, ["v", "kind"], "left_anti").select("v", "kind", F.round(1 - F.exp("l"), 9).alias("score"))
        )
    return scored.where(F.col("score") >= min_score)


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
    min_seeds: int = MIN_SEEDS, min_score: float = MIN_SCORE,
) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, all_spans, text_key) for every row of ``docs``.

    Base spans are the leftmost non-overlapping matches of each kind that pass its check (an ip's parts at
    most 255, a card's 13 to 19 digits with a right check sum, a phone's 9 to 15 digits). All of them seed the method:
    a seed's pattern is the two words before it (fewer at the start of a text, and as far as they lie in the
    CONTEXT characters before) and its shape (runs of digits, capitals and small letters).
    Patterns and the values they hold form a graph that ``learn`` scores. Words with a digit or @ and
    groups of words that look like a card or phone but fail its check, of MIN_CHARS characters and more, are new
    spans of kind ``ctx_email`` and so on if their pattern is trusted, unless they touch a base span. Base spans stay as they are; the
    four counts and ``base_sha256`` speak of base spans alone. ``spans`` lists all of them, the new kinds last.

    Null texts count as empty. Null ids and repeated rows are kept, each with its own result; an empty table gives
    no rows; further columns are ignored. Texts are read once and never shuffled: what is found is staged,
    and the graph, which grows with the words that hold digits, is built from that.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    every = docs.select(F.col(id_col).alias("id"), text.alias("text")).select(
        "id", F.xxhash64("text").alias("text_key"), marks(F.col("text")).alias("marks")
    )
    base = F.transform(F.filter("marks", lambda m: m["k"].isNotNull()), lambda m: F.struct(m["k"].alias("k"), m["s"].alias("s"), m["e"].alias("e")))
    seen = stage(every.select("id", "text_key", base.alias("base"), F.col("marks").alias("words")), "pii-found")
    each = seen.where(F.size("words") > 0).select("text_key", "base", F.explode("words").alias("w"))
    touched = F.exists("base", lambda b: (b["s"] < F.col("w.e")) & (F.col("w.s") < b["e"]))
    occurrences = stage(each.where(F.col("w.k").isNotNull() | ~touched).select(
        "text_key", F.col("w.s").alias("s"), F.col("w.e").alias("e"), lower_ascii(F.col("w.v")).alias("v"),
        F.concat_ws("\t", "w.left", "w.shape").alias("pattern"), F.col("w.k").alias("kind"),
    ).distinct(), "pii-words")
    trusted = learn(occurrences, rounds, min_seeds, min_score)
    new = occurrences.where("kind is null").drop("kind").join(trusted, "pattern")
    best = new.groupBy("text_key", "s", "e").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b"))
    added = best.groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct(
        (len(KINDS) - F.col("b.k")).cast("int").alias("k"), F.col("s").cast("int").alias("s"), F.col("e").cast("int").alias("e")
    ))).alias("added"))
    joined = seen.drop("words").join(added, "text_key", "left")
    spans = F.concat("base", F.coalesce("added", F.array().cast(_SPAN)))
    names = [*KINDS, *(f"ctx_{k}" for k in KINDS)]
    count = lambda k: F.size(F.filter("base", lambda b: b["k"] == k)).cast("bigint")
    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return joined.select(
        F.col("id").alias(id_col), *counts, F.sha2(spans_text(F.col("base"), names).cast("binary"), 256).alias("base_sha256"),
        spans_text(spans, names).alias("spans"), spans.alias("all_spans"), "text_key",
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by ``[PII]``; spans that touch or overlap become one."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["s"].alias("s"), s["e"].alias("e"))))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    merged = F.aggregate(
        ordered, state,
        lambda acc, s: F.when(s["s"] < acc["at"], F.struct(F.greatest(acc["at"], s["e"]).alias("at"), acc["out"].alias("out"))).otherwise(
            F.struct(s["e"].alias("at"), F.concat(
                acc["out"], F.array(F.substring(text, acc["at"] + 1, s["s"] - acc["at"]), F.lit("[PII]"))
            ).alias("out"))
        ),
    )
    rest = F.substring(text, merged["at"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(merged["out"], ""), rest)).otherwise(text)
