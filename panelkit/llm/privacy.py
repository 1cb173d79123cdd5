"""Personal data: fixed patterns and information-theoretic sanitisation, in DataFrame operations only.

Entities (addresses and numbers that the patterns find) are to be protected.  A term that occurs
in an entity's documents, anywhere outside the patterns' spans, reveals it even where the entity itself is cut out.  How strongly is
estimated from the whole corpus: with document frequencies df and N documents,

    disclosure(term, entity) = PMI(term, entity) / IC(entity)
                             = log(N df(t, e) / (df(t) df(e))) / log(N / df(e))

is 1 if the term occurs only with the entity and 0 if it tells nothing.  A term counts as
evidence only if ``MIN_CONTEXTS`` of the documents that hold both pairwise share few other words (by
a sketch of their words): exact and near copies of one document count as one, and however many there
are, they hide no others.  Terms at or above ``REMOVE_AT`` are removed, those at or above
``GENERALISE_AT`` are replaced by a placeholder, wherever they occur.

Positions come without any loop over characters: the matches of a pattern and the stretches
between them alternate, so running sums of their lengths are the offsets.  Running sums and maxima
(``running``) are taken within chunks of about the square root of an array and then over the chunks,
and texts are cut at positions through blocks of equal length, so a text with very many matches costs
little more than its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Words of a document, those of smallest hash, by which it is compared to others.
SKETCH = 16
#: Independent documents in which a term has to occur with an entity.
MIN_CONTEXTS = 3
#: Documents are independent if their sketches share at most this part of the other words of the shorter one.
MAX_SHARED = 0.5
#: Slices into which the contexts of one entity and term are dealt.
SLICES = 16
GENERALISE_AT, REMOVE_AT = 0.9, 0.97

KINDS = ("email", "ip", "card", "phone", "term")

#: The contract's patterns.  Possessive repeats and the look-behind (a match starts at the edge
#: of its run, or where the last one ended) find the same matches without re-reading long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that every text with a valid match passes.
HINTS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: t.contains("+"),
}
WORD = r"\p{L}+"
#: Code points of the blocks through which a text is cut.
BLOCK = 4096
SPAN = "struct<kind:string,rank:int,start:bigint,end:bigint,value:string>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits of a number pass the Luhn test."""
    each = F.transform(F.split(F.reverse(number), "(?<=.)(?=.)"), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def small_part(part: Column) -> Column:
    """Whether a run of digits is at most 255."""
    short = F.regexp_replace(part, "^0+", "")
    return (F.length(short) <= 3) & (F.when(short == "", 0).otherwise(
        F.substring(short, 1, 3).cast("int")) <= 255)


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), small_part),
    "card": lambda v: F.length(digits(v)).between(14, 19) & luhn(digits(v)),
    "phone": lambda v: F.length(digits(v)).between(10, 15),
}


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, merge) -> Column:
    """The array of ``merge`` (of two columns, associative) over the values up to each place."""
    def last(array: Column) -> Column:
        return F.element_at(array, -1)

    def grow(array: Column, x: Column) -> Column:
        return F.concat(array, F.array(F.when(F.size(array) == 0, x).otherwise(merge(last(array), x))))

    def folded(array: Column) -> Column:
        return F.aggregate(array, F.array().cast("array<bigint>"), grow)

    def over(xs: Column) -> Column:
        side = F.ceil(F.sqrt(F.size(xs))).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / side).cast("int")),
                             lambda i: folded(F.slice(xs, i * side + 1, side)))
        return let(chunks, lambda c: let(folded(F.transform(c, last)), lambda before: F.flatten(F.transform(
            c, lambda chunk, i: F.when(i == 0, chunk).otherwise(
                F.transform(chunk, lambda x: merge(F.get(before, i - 1), x)))))))

    return let(values, lambda xs: F.when(F.size(xs) > 0, over(xs)).otherwise(F.array().cast("array<bigint>")))


def located(text: Column, pattern: Column) -> Column:
    """Array of (start, end, value) of the matches of a pattern, in code points."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def placed(values: Column) -> Column:
        pairs = F.slice(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), values.alias("value")), 1, F.size(values))
        lengths = F.transform(pairs, lambda p: (F.length(p["gap"]) + F.length(p["value"])).cast("bigint"))
        ends = running(lengths, lambda a, x: a + x)
        return F.transform(F.arrays_zip(ends.alias("end"), values.alias("value")), lambda p: F.struct(
            (p["end"] - F.length(p["value"])).alias("start"), p["end"].alias("end"), p["value"].alias("value")))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)),
               lambda values: F.when(F.size(values) > 0, placed(values)).otherwise(empty))


def pattern_spans(text: Column, kind: str) -> Column:
    """Valid spans of one kind; matches that fail their test are dropped, not retried."""
    none = F.array().cast(f"array<{SPAN}>")
    found = F.filter(located(text, F.lit(PATTERNS[kind])), lambda s: VALID[kind](s["value"]))
    typed = F.transform(found, lambda s: F.struct(
        F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("rank"), s["start"].alias("start"),
        s["end"].alias("end"), s["value"].alias("value")))
    return F.when(HINTS[kind](text), typed).otherwise(none)


def ordered(spans: Column) -> Column:
    """Spans by start, then kind."""
    return F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s.alias("span")))),
        lambda s: s["span"])


def cleaned(text: Column, spans: Column, actions: Column) -> Column:
    """The text with its spans (by start) removed or generalised to ``<kind>``."""
    def cut(blocks: Column, start: Column, end: Column) -> Column:
        """The text from ``start`` to ``end`` (exclusive), read from the blocks that hold it."""
        first, last = F.floor(start / BLOCK).cast("int"), F.floor((end - 1) / BLOCK).cast("int")
        part = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
        return F.when(end > start, F.substring(part, (start % BLOCK).cast("int") + 1, (end - start).cast("int"))).otherwise("")

    def rest(blocks: Column, ends: Column) -> Column:
        """What stands before each span, with its placeholder, and what stands behind the last."""
        pieces = F.transform(F.arrays_zip(spans.alias("span"), actions.alias("action")), lambda p, i: F.concat(
            cut(blocks, F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(ends, i - 1)), p["span"]["start"]),
            F.when(p["action"] == "generalise", F.concat(F.lit("<"), p["span"]["kind"], F.lit(">"))).otherwise("")))
        behind = cut(blocks, F.element_at(ends, -1), F.length(text).cast("bigint"))
        return F.concat(F.array_join(pieces, ""), behind)

    blocks = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))
    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest)
    return F.when(F.size(spans) > 0, let(blocks, lambda b: let(ends, lambda e: rest(b, e)))).otherwise(text)


def entity(span: Column) -> Column:
    """What a span stands for: equal addresses and numbers however they are written."""
    return F.concat(span["kind"], F.lit(":"), F.when(span["kind"] == "email", F.lower(span["value"])).when(
        span["kind"] == "ip", span["value"]).otherwise(digits(span["value"])))


def distinct_words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))


def removed(spans: Column) -> Column:
    """The action ``remove`` for every span."""
    return F.transform(spans, lambda s: F.lit("remove"))


def base_spans(docs: DataFrame, keep=lambda text: text) -> DataFrame:
    """doc_id, h (hash of the text), the patterns' spans and ``clean`` (``keep`` of the text without
    them); of rows with spans also their distinct entities, the distinct words outside the spans and those
    that occur only inside."""
    text = F.coalesce("text", F.lit(""))
    spans = F.concat(*[pattern_spans(F.col("text"), k) for k in PATTERNS])
    rows = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("h"), ordered(spans).alias("spans"))
    blank = F.transform("spans", lambda s: s.withField("kind", F.lit("")))
    outside = cleaned(F.col("text"), blank, F.array_repeat(F.lit("generalise"), F.size("spans")))
    held = F.size("spans") > 0
    clean = cleaned(F.col("text"), F.col("spans"), removed(F.col("spans")))
    rows = rows.select("doc_id", "text", "h", "spans", keep(clean).alias("clean"), F.when(held, distinct_words(outside)).alias("words"))
    return rows.select("doc_id", "h", "spans", "clean", F.array_distinct(F.transform("spans", entity)).alias("entities"), "words",
                       F.when(held, F.array_except(distinct_words(F.col("text")), "words")).alias("inner"))


def shared_part(a: Column, b: Column) -> Column:
    """The part of the shorter word list that both have; an empty list proves nothing."""
    short = F.least(F.size(a), F.size(b))
    return F.when(short > 0, F.size(F.array_intersect(a, b)) / short).otherwise(1.0)


def independent(contexts: DataFrame, wanted: int) -> DataFrame:
    """(entity, term) of which ``wanted`` contexts (distinct sketches ``words`` besides the term) pairwise
    share at most ``MAX_SHARED``.

    The next context is each time the one that shares least with those chosen, and the first
    is the one farthest from an arbitrary context; so more copies of a context change nothing.
    Every round is one aggregate that combines map side; no group of contexts meets in a task.
    """
    keys, order = ["entity", "term"], F.xxhash64("words")
    rows = written(contexts.select(*keys, "words", F.pmod(order, F.lit(SLICES)).cast("int").alias("slice")), "privacy-contexts")
    chosen = rows.groupBy(*keys).agg(F.array(F.min_by("words", order)).alias("chosen"))
    for i in range(wanted):
        dealt = chosen.select(*keys, "chosen", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice"))
        near = F.array_max(F.transform("chosen", lambda c: shared_part(F.col("words"), c)))
        best = (rows.join(dealt, [*keys, "slice"]).withColumn("near", near).groupBy(*keys)
                .agg(F.min_by(F.struct("words", "near", "chosen"), F.struct("near", order)).alias("best")))
        if i == 0:
            chosen = best.select(*keys, F.array("best.words").alias("chosen"))
        else:
            chosen = best.where(F.col("best.near") <= MAX_SHARED).select(
                *keys, F.concat("best.chosen", F.array("best.words")).alias("chosen"))
    return chosen.select(*keys)


def disclosing_terms(docs: DataFrame, found: DataFrame, min_contexts: int = MIN_CONTEXTS,
                     generalise_at: float = GENERALISE_AT) -> DataFrame:
    """(term, disclosure): terms whose strongest entity they reveal to ``generalise_at`` or more.

    ``found`` is the materialised result of ``base_spans``.  Word counts are summed map side and
    meet the candidate terms as one row per word.  All four counts are of rows of ``docs``; only rows
    with an entity of ``min_contexts`` rows are joined, dealt into slices.
    """
    sketch = F.slice(F.array_sort(F.transform("words", lambda w: F.xxhash64(w))), 1, SKETCH)
    held = found.where(F.size("spans") > 0).select(
        "words", sketch.alias("sketch"), F.pmod(F.xxhash64("doc_id", "h"), F.lit(SLICES)).cast("int").alias("slice"),
        F.explode("entities").alias("entity"))
    every = F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("slice")
    df_entity = written(held.groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity"))
                        .where(F.col("df_entity") >= min_contexts), "privacy-entities")
    beside = held.join(df_entity.select("entity", every), ["entity", "slice"]).select(
        "entity", "slice", "sketch", F.explode("words").alias("term"))
    pairs = (beside.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both"))
             .where(F.col("both") >= min_contexts))
    pairs = written(pairs, "privacy-pairs")
    # words that a row holds only inside spans are no terms there
    counted = docs.select(F.explode(distinct_words(F.col("text"))).alias("term"), F.lit(1).alias("n")).unionAll(
        found.select(F.explode("inner").alias("term"), F.lit(-1).alias("n")))
    df_term = counted.groupBy("term").agg(F.sum("n").alias("df_term"))
    n = docs.agg(F.count(F.lit(1)).cast("double").alias("n_docs"))
    scored = pairs.join(df_term, "term").join(df_entity, "entity").crossJoin(F.broadcast(n))  # n is one row
    content = F.log(F.col("n_docs") / F.col("df_entity"))
    pmi = F.log(F.col("n_docs") * F.col("both") / (F.col("df_term").cast("double") * F.col("df_entity")))
    value = F.when(content > 0, pmi / content).otherwise(0.0)
    strong = scored.select("entity", "term", value.alias("disclosure")).where(F.col("disclosure") >= generalise_at)
    strong = written(strong, "privacy-strong")
    other = F.array_remove("sketch", F.xxhash64("term"))
    contexts = beside.join(strong.select("entity", "term", every), ["entity", "term", "slice"]).select(
        "entity", "term", other.alias("words")).distinct()
    return (strong.join(independent(contexts, min_contexts), ["entity", "term"])
            .groupBy("term").agg(F.max("disclosure").alias("disclosure")))


def term_hits(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(hit_id, hit_h, terms: term to disclosure) of the documents that hold a disclosing term."""
    return (docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("h"),
                                                  F.explode(distinct_words(F.col("text"))).alias("term")).join(terms, "term")
            .groupBy(F.col("doc_id").alias("hit_id"), F.col("h").alias("hit_h"))
            .agg(F.map_from_entries(F.collect_set(F.struct("term", "disclosure"))).alias("terms")))


def same_text(left: str = "doc_id", right: str = "hit_id") -> Column:
    return F.col(left).eqNullSafe(F.col(right)) & (F.col("h") == F.col("hit_h"))


def free_terms(spans: Column) -> Column:
    """Spans by start and kind without the terms that overlap another kind's span: the farthest end
    before a term and the next start behind it decide."""
    far = F.lit(1 << 62)
    ends = running(F.transform(spans, lambda s: F.when(s["kind"] == "term", F.lit(-1)).otherwise(s["end"]).cast("bigint")), F.greatest)
    starts = F.reverse(running(F.reverse(F.transform(
        spans, lambda s: F.when(s["kind"] == "term", far).otherwise(s["start"]))), F.least))
    zipped = F.arrays_zip(spans.alias("span"), ends.alias("before"), starts.alias("next"))
    return F.transform(F.filter(zipped, lambda z: (z["span"]["kind"] != "term") | (
        (z["before"] <= z["span"]["start"]) & (z["next"] >= z["span"]["end"]))), lambda z: z["span"])


def term_spans(docs: DataFrame, found: DataFrame, hits: DataFrame, remove_at: float, keep) -> DataFrame:
    """(hit_id, hit_h, all spans, their actions, clean) of the distinct documents with a disclosing term."""
    rows = docs.where("text IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("h"))
    once = (rows.join(hits, same_text()).select("doc_id", "h", "text", "terms").dropDuplicates(["doc_id", "h"])
            .withColumnsRenamed({"doc_id": "hit_id", "h": "hit_h"}))
    base = found.select("doc_id", "h", "spans").join(hits.select("hit_id", "hit_h"), same_text(), "left_semi").dropDuplicates(["doc_id", "h"])
    once = once.join(base, same_text()).select("hit_id", "hit_h", "text", "terms", "spans")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(F.map_keys("terms"), "|"), F.lit(r")(?!\p{L})"))
    placed = F.transform(located(F.col("text"), pattern), lambda s: F.struct(
        F.lit("term").alias("kind"), F.lit(4).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    once = once.withColumn("spans", let(ordered(F.concat("spans", placed)), free_terms))
    action = F.transform("spans", lambda s: F.when(s["kind"] != "term", F.lit("remove")).when(
        F.element_at("terms", F.lower(s["value"])) >= remove_at, F.lit("remove")).otherwise(F.lit("generalise")))
    once = once.withColumn("actions", action)
    return once.select("hit_id", "hit_h", F.col("spans").alias("all_spans"), "actions",
                       keep(cleaned(F.col("text"), F.col("spans"), F.col("actions"))).alias("all_clean"))


def sanitise(docs: DataFrame, min_contexts: int = MIN_CONTEXTS, generalise_at: float = GENERALISE_AT,
             remove_at: float = REMOVE_AT, keep=lambda text: text) -> DataFrame:
    """doc_id, ``spans`` (kind, rank, start, end, value; by start and kind), ``action`` per span and the
    sanitised text ``clean`` (or what ``keep`` makes of that column before it is stored) of every row of ``docs``.

    Terms are letters only, compared in lower case; a term inside a pattern's span adds nothing.
    NULL and empty texts have no spans and an empty clean text; NULL doc_ids and repeated rows are
    carried as they are; other columns are ignored; an empty table gives an empty result.
    """
    found = written(base_spans(docs, keep), "privacy-spans")
    terms = written(disclosing_terms(docs, found, min_contexts, generalise_at), "privacy-terms")
    hits = written(term_hits(docs, terms), "privacy-hits")  # its size is known when texts are joined
    extra = written(term_spans(docs, found, hits, remove_at, keep), "privacy-found")
    return found.join(extra, same_text(), "left").select(
        "doc_id", "h", F.coalesce("all_spans", "spans").alias("spans"),
        F.when(F.col("hit_h").isNotNull(), F.col("actions")).otherwise(removed(F.col("spans"))).alias("actions"),
        F.when(F.col("hit_h").isNotNull(), F.col("all_clean")).otherwise(F.col("clean")).alias("clean"))
