"""Personal data by patterns, and terms that give it away by their co-occurrence in the corpus."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import written

# Kinds in the order of results, and their patterns. Runs are matched possessively and email addresses and
# numbers begin at the edge of a run, which finds the same matches in time linear in the text.
KINDS = ("email", "ip", "card", "phone", "term", "cue")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: A term is any word of letters and digits, except one of one or two Latin letters.
WORD = r"[\p{L}\p{M}\p{N}]"
TERM = rf"{WORD}{{3,}}+|(?<!{WORD})(?!\p{{IsLatin}}{{1,2}}+(?!{WORD})){WORD}{{1,2}}+"

#: Characters on each side of an entity that count as its context.
CONTEXT = 120
#: A term is judged if it stands in the context of one entity in so many different texts.
MIN_TEXTS = 2
#: Bits by which seeing the term must raise the chance of the entity over its share of the corpus.
MIN_BITS = 6.0
#: Share of a term's occurrences near one entity from which it is generalised, and from which it is removed.
GENERALISE_SHARE = 0.5
REMOVE_SHARE = 0.9

#: Size of the bit set that sifts words before they are joined; it sifts less well if there are very many terms.
BITS = 1 << 18
#: Bits that each word sets there, so that hardly a common word passes for another.
HASHES = 3
#: Items of an array that are scanned together, and characters of a text.
BLOCK = 128
TEXT_BLOCK = 256
#: What stands for each character of a base span where words are looked for.
BLANK = "\0"

TAGS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "cue": ""}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """Whether the 16 to 19 digits pass the check sum; counted from the last, every second digit is doubled."""
    digits = F.reverse(_digits(match))

    def value(place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when(place % 2 == 1, digit).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda sum_, place: sum_ + value(place))
    return F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(F.lit(False))


def _is_ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        short = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(F.length(short) <= 3, short.cast("int") <= 255).otherwise(F.lit(False))

    return F.forall(F.split(match, r"\."), small)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda match: F.lit(True),
    "ip": _is_ip,
    "card": _luhn,
    "phone": lambda match: F.length(_digits(match)).between(8, 15),
}


def _running(items: Column, zero: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """For each item the state before it, by ``state = step(state, item)``; in blocks, so that long arrays stay cheap."""
    nothing = F.lit(None).cast(f"array<{kind}>")
    empty = F.coalesce(nothing, F.array().cast(f"array<{kind}>"))

    def scan(block: Column, start: Column) -> Column:
        begin = F.struct(start.cast(kind).alias("now"), empty.alias("all"))
        return F.aggregate(
            block, begin, lambda acc, x: F.struct(step(acc["now"], x).cast(kind).alias("now"), F.concat(acc["all"], F.array(acc["now"])).alias("all"))
        )

    numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int"))
    blocks = F.transform(numbers, lambda b: F.slice(items, b * BLOCK + 1, BLOCK))
    begin = F.struct(zero.cast(kind).alias("now"), empty.alias("all"))
    starts = F.aggregate(
        blocks,
        begin,
        lambda acc, block: F.struct(
            F.aggregate(block, acc["now"], lambda now, x: step(now, x).cast(kind)).alias("now"), F.concat(acc["all"], F.array(acc["now"])).alias("all")
        ),
    )["all"]
    return F.flatten(F.zip_with(blocks, starts, lambda block, start: scan(block, start)["all"]))


def _mention_of(kind: str) -> Callable[[Column, Column], Column]:
    """A mention from the i-th pair of a match and the length of the gap before it."""

    def mention(pair: Column, i: Column) -> Column:
        start = F.get("before", i) + pair["gap"]
        entity = F.lower(pair["match"]) if kind in ("email", "ip") else _digits(pair["match"])
        return F.struct(
            start.alias("start"),
            (start + F.length(pair["match"])).alias("end"),
            F.concat(F.lit(f"{kind}:"), entity).alias("entity"),
            VALID[kind](pair["match"]).alias("valid"),
        )

    return mention


def _span_of(kind: int) -> Callable[[Column], Column]:
    return lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"))


def _mentions(docs: DataFrame) -> DataFrame:
    """Adds, for each kind, an array of its valid matches: start, end and entity."""
    for kind, pattern in PATTERNS.items():
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        if NEEDS[kind]:
            found = F.when(F.contains("text", F.lit(NEEDS[kind])), found)
        docs = docs.withColumn("found", found)
        docs = docs.withColumn("gaps", F.when(F.size("found") > 0, F.split("text", pattern, -1)))
        pairs = F.zip_with(
            "found", F.slice("gaps", F.lit(1), F.size("found")), lambda match, gap: F.struct(match.alias("match"), F.length(gap).alias("gap"))
        )
        docs = docs.withColumn("pairs", F.when(F.size("found") > 0, pairs))
        before = _running(F.col("pairs"), F.lit(0), lambda now, x: now + x["gap"] + F.length(x["match"]), "int")
        docs = docs.withColumn("before", F.when(F.size("found") > 0, before))
        mentions = F.filter(F.transform("pairs", _mention_of(kind)), lambda m: m["valid"])
        docs = docs.withColumn(kind, F.when(F.size("found") > 0, mentions)).drop("found", "gaps", "pairs", "before")
    return docs


def _blocks(text: str) -> Column:
    """The text in blocks of TEXT_BLOCK characters, so that a piece of it is cut out without walking through all before it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))


def _piece(blocks: str, start: Column, end: Column) -> Column:
    """The characters from ``start`` up to ``end`` of a text in blocks."""
    first = F.floor(start / TEXT_BLOCK).cast("int")
    near = F.slice(blocks, first + 1, F.floor(end / TEXT_BLOCK).cast("int") - first + 1)
    return F.substring(F.array_join(near, ""), start % TEXT_BLOCK + 1, end - start)


def _blanked(docs: DataFrame) -> DataFrame:
    """Adds ``blank``, the text of the same length with BLANK for each character of a base span; null if there is no span."""
    docs = docs.withColumn("ordered", F.when(F.size("base") > 0, F.array_sort(F.transform("base", lambda s: F.struct(s["start"], s["end"])))))
    docs = docs.withColumn("reached", F.when(F.size("base") > 0, _running(F.col("ordered"), F.lit(0), lambda now, s: F.greatest(now, s["end"]), "int")))
    docs = docs.withColumn("blocks", F.when(F.size("base") > 0, _blocks("text")))

    def part(span: Column, at: Column) -> Column:
        before = F.when(span["start"] > at, _piece("blocks", at, span["start"])).otherwise("")
        return F.concat(before, F.repeat(F.lit(BLANK), F.greatest(F.lit(0), span["end"] - F.greatest(at, span["start"]))))

    last = F.array_max(F.transform("ordered", lambda s: s["end"]))
    blank = F.concat(F.array_join(F.zip_with("ordered", "reached", part), ""), _piece("blocks", last, F.length("text")))
    return docs.withColumn("blank", F.when(F.size("base") > 0, blank)).drop("ordered", "reached", "blocks")


def _free_chars(text: Column) -> Column:
    return F.length(F.translate(text, BLANK, ""))


def _contexts(docs: DataFrame) -> DataFrame:
    """Adds ``contexts`` (array of entity, n_chars, terms): the stretches of ``blank`` within CONTEXT characters of an entity.

    Where those of several mentions of one entity meet they are one, so that no word counts twice. Characters of base
    spans do not count, nor do words cut by an edge.
    """
    mentions = F.transform(
        "mentions",
        lambda m: F.struct(
            m["entity"].alias("entity"),
            F.greatest(F.lit(0), m["start"] - CONTEXT).alias("start"),
            F.least(F.length("blank"), m["end"] + CONTEXT).alias("end"),
        ),
    )
    docs = docs.withColumn("windows", F.when(F.size("base") > 0, F.array_sort(mentions)))
    docs = docs.withColumn("blocks", F.when(F.size("base") > 0, _blocks("blank")))

    def begins(window: Column, i: Column) -> Column:
        before = F.get("windows", i - 1)
        return (i == 0) | (window["entity"] != before["entity"]) | (window["start"] > before["end"])

    firsts = F.filter(F.transform("windows", lambda w, i: F.when(begins(w, i), i)), lambda i: i.isNotNull())
    docs = docs.withColumn("firsts", firsts)

    def stretch(i: Column, j: Column) -> Column:
        last = F.coalesce(F.get("firsts", j + 1), F.size("windows")) - 1
        start, end = F.get("windows", i)["start"], F.get("windows", last)["end"]
        # One character more on each side shows whether a word is cut.
        return F.struct(
            F.get("windows", i)["entity"].alias("entity"),
            _piece("blocks", start, end).alias("text"),
            F.when(start > 0, _piece("blocks", start - 1, start)).otherwise("").alias("left"),
            _piece("blocks", end, end + 1).alias("right"),
        )

    docs = docs.withColumn("stretches", F.transform("firsts", stretch))

    def context(s: Column) -> Column:
        text = F.when(s["left"].rlike(f"{WORD}$"), F.regexp_replace(s["text"], f"^{WORD}++", "")).otherwise(s["text"])
        text = F.when(s["right"].rlike(f"^{WORD}"), F.regexp_replace(text, f"(?<!{WORD}){WORD}++$", "")).otherwise(text)
        return F.struct(s["entity"].alias("entity"), _free_chars(s["text"]).cast("long").alias("n_chars"), _words(text).alias("terms"))

    return docs.withColumn("contexts", F.transform("stretches", context)).drop("windows", "blocks", "firsts", "stretches")


def _words(text: Column | str) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


def find_base(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, text_key, base (array of kind, start, end), n_chars outside of them, and contexts (array
    of entity, n_chars, terms). Where there are base spans also text and blank, the same with them blanked; else null.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    found = _mentions(rows.withColumn("text_key", F.xxhash64("text")))
    spans, mentions = [], []
    for i, kind in enumerate(PATTERNS):
        own = F.transform(kind, _span_of(i))
        spans.append(F.coalesce(own, F.array().cast("array<struct<kind:int,start:int,end:int>>")))
        named = F.transform(kind, lambda m: F.struct(m["entity"].alias("entity"), m["start"].alias("start"), m["end"].alias("end")))
        mentions.append(F.coalesce(named, F.array().cast("array<struct<entity:string,start:int,end:int>>")))
    found = found.withColumn("base", F.concat(*spans)).withColumn("mentions", F.concat(*mentions))
    found = _contexts(_blanked(found))
    return found.select(
        "doc_id",
        "text_key",
        "base",
        F.coalesce(_free_chars(F.col("blank")), F.length("text")).alias("n_chars"),
        F.coalesce("contexts", F.array().cast("array<struct<entity:string,n_chars:bigint,terms:array<string>>>")).alias("contexts"),
        F.when(F.size("base") > 0, F.col("text")).alias("text"),
        "blank",
    )


def _term_filter(terms: DataFrame) -> Callable[[Column], Column]:
    """A test that every one of ``terms`` passes, and few others: a bit set of fixed size over their hashes.

    What reaches the driver is at most BITS / 64 numbers, whatever the number of terms.
    """

    def places(term: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(term, F.lit(i)), F.lit(BITS)) for i in range(HASHES)]

    place = F.explode(F.array(*places(F.col("term")))).alias("place")
    word, bit = F.floor(F.col("place") / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int"))
    words = terms.select(place).select(word.alias("word"), bit.alias("bit"))
    set_ = {row["word"]: row["bits"] for row in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()}
    bits = F.from_json(F.lit(json.dumps([set_.get(i, 0) for i in range(BITS // 64)])), "array<bigint>")

    def has(place: Column) -> Column:
        word = F.get(bits, F.floor(place / 64).cast("int"))
        return F.call_function("shiftrightunsigned", word, (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1

    def passes(term: Column) -> Column:
        first, *others = map(has, places(term))
        for other in others:
            first = first & other
        return first

    return passes


def revealing_terms(base: DataFrame, docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Terms (term, kind) that disclose an entity: kind 'term' to be generalised, 'cue' to be removed.

    All counts are of what lies outside base spans. For a term t and an entity e, P(e | t) is the share of t's occurrences
    in the corpus that stand in a context of e, and P(e) the share of the corpus, in characters, that lies in contexts
    of e. t discloses e by log2(P(e | t) / P(e)) bits. It is listed if that reaches MIN_BITS and P(e | t) reaches
    GENERALISE_SHARE (term) or REMOVE_SHARE (cue). Pairs are counted before they are shuffled, and only pairs seen in
    MIN_TEXTS different texts go on, so the copies of one text cannot make its words suspect.
    """
    contexts = base.select("text_key", F.explode("contexts").alias("near")).select("text_key", "near.entity", F.explode("near.terms").alias("term"))
    per_text = contexts.groupBy("entity", "term", "text_key").agg(F.count("*").alias("n"))
    joint = per_text.groupBy("entity", "term").agg(F.sum("n").alias("n_joint"), F.count("*").alias("n_texts")).where(F.col("n_texts") >= MIN_TEXTS)
    joint = written(joint, "joint")
    if joint.isEmpty():  # not by createDataFrame, for which each executor would start Python workers
        return joint.select("term", F.lit(None).cast("string").alias("kind")).limit(0)
    wanted = _term_filter(joint.select("term").distinct())

    def counted(rows: DataFrame, text: Column, n: int) -> DataFrame:
        return rows.select(F.explode(F.filter(_words(text), wanted)).alias("term")).groupBy("term").agg((F.count("*") * n).alias("n"))

    # Words of all texts, less those of texts with base spans, plus what blanking leaves of these.
    marked = base.where(F.col("blank").isNotNull())
    counts = counted(docs, F.coalesce(F.col(text_column), F.lit("")), 1)
    counts = counts.unionByName(counted(marked, F.col("text"), -1)).unionByName(counted(marked, F.col("blank"), 1))
    judged = written(joint.join(counts.groupBy("term").agg(F.sum("n").alias("n_term")), "term"), "judged")
    total = base.agg(F.sum("n_chars").alias("n")).first()["n"]
    mentions = base.select(F.explode("contexts").alias("near")).groupBy("near.entity").agg(F.sum("near.n_chars").alias("n_near"))
    share = F.col("n_joint") / F.col("n_term")
    bits = F.log2(share / (F.greatest(F.lit(1), "n_near") / F.lit(float(max(total, 1)))))
    strong = judged.join(mentions, "entity").where((bits >= MIN_BITS) & (share >= GENERALISE_SHARE))
    kind = F.when(F.max(share) >= REMOVE_SHARE, "cue").otherwise("term")
    return strong.groupBy("term").agg(kind.alias("kind")).select("term", "kind")


def _term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """For documents (doc_id, text, text_key) with listed terms: doc_id, text_key, found (array of kind, start, end)."""
    passes = _term_filter(terms)
    words = docs.withColumn("words", F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))
    words = words.where(F.exists("words", lambda w: passes(F.lower(w))))
    words = words.withColumn("gaps", F.split("text", TERM, -1))
    pairs = F.zip_with("words", F.slice("gaps", F.lit(1), F.size("words")), lambda w, gap: F.struct(w.alias("word"), F.length(gap).alias("gap")))
    words = words.withColumn("pairs", pairs)
    words = words.withColumn("before", _running(F.col("pairs"), F.lit(0), lambda now, x: now + x["gap"] + F.length(x["word"]), "int"))
    placed = F.zip_with(
        "pairs",
        "before",
        lambda pair, before: F.struct(
            F.lower(pair["word"]).alias("term"), (before + pair["gap"]).alias("start"), (before + pair["gap"] + F.length(pair["word"])).alias("end")
        ),
    )
    placed = words.select("doc_id", "text_key", F.explode(F.filter(placed, lambda p: passes(p["term"]))).alias("p")).select("doc_id", "text_key", "p.*")
    listed = terms.select("term", (F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")) - 1).cast("int").alias("kind"))
    hits = placed.join(listed, "term").groupBy("doc_id", "text_key")
    return hits.agg(F.collect_set(F.struct("kind", "start", "end")).alias("found"))


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, base and spans, arrays of (kind, start, end).

    ``base`` holds what the patterns find: email, ip, card and phone as kinds 0 to 3, by kind and start, in code points
    with exclusive ends. ``spans`` holds the same and then the terms that disclose such data (kind 4, to be
    generalised, and 5, to be removed), except where they overlap a base span.

    Null and empty texts have no spans. Null ids, repeated rows and ids that several texts share are kept apart by a hash
    of the text (``text_key``). Other columns are ignored; an empty table gives no rows.
    """
    base = written(find_base(docs, id_column, text_column), "base")
    terms = written(revealing_terms(base, docs, text_column), "terms")
    found = base.select("doc_id", "text_key", "base")
    if terms.isEmpty():
        return found.withColumn("spans", F.col("base"))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    # In texts with base spans, words that touch one are found as they were counted: in what blanking leaves.
    marked = base.where(F.col("blank").isNotNull()).select("doc_id", F.col("blank").alias("text"), "text_key")
    more = _term_spans(rows.withColumn("text_key", F.xxhash64("text")).unionByName(marked), terms)
    more = more.select(F.col("doc_id").alias("id_"), F.col("text_key").alias("key_"), "found")
    both = found.join(more, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("text_key") == F.col("key_")), "left")
    free = F.filter("found", lambda t: ~F.exists("base", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])))
    spans = F.when(F.col("found").isNull(), F.col("base")).otherwise(F.concat("base", F.array_sort(free)))
    return both.select("doc_id", "text_key", "base", spans.alias("spans"))


def span_list(spans: str) -> Column:
    """The spans as text: kind:start:end, comma-joined, in their order."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with its text column redacted: personal data become tags, terms a tag, cues nothing.

    Spans that overlap give the tag of the one that begins first (of these, the longest); all they cover goes. Every
    other character, every other column and every row stays as it is; null texts stay null.
    """
    found = find_personal_data(docs, id_column, text_column).where(F.size("spans") > 0)
    found = found.select(F.col("doc_id").alias("found_id"), F.col("text_key").alias("found_key"), "spans").distinct()
    # The row travels as one column, so that no column of it can be taken for one of these.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    ).withColumn("text_key", F.xxhash64("text"))
    marked = rows.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("text_key") == F.col("found_key")), "left")
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"))))
    marked = marked.withColumn("ordered", ordered)
    reached = _running(F.col("ordered"), F.lit(0), lambda now, s: F.greatest(now, -s["minus_end"]), "int")
    marked = marked.withColumn("reached", F.when(F.size("ordered") > 0, reached))
    tags = F.array(*[F.lit(TAGS[kind]) for kind in KINDS])
    parts = F.zip_with(
        "ordered",
        "reached",
        lambda s, at: F.when(s["start"] >= at, F.concat(F.substring("text", at + 1, s["start"] - at), F.get(tags, s["kind"]))).otherwise(F.lit("")),
    )
    last = F.array_max(F.transform("ordered", lambda s: -s["minus_end"]))
    rest = F.substring("text", last + 1, F.length("text"))
    clean = F.when(F.col("spans").isNotNull(), F.concat(F.array_join(parts, ""), rest)).otherwise(F.col("row").getField(text_column))
    return marked.select(*[(clean if c == text_column else F.col("row").getField(c)).alias(c) for c in docs.columns])
