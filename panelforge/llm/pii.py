"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Entities are found by pattern.  Around each the words of a short context are the candidates that could give it
away.  Corpus co-occurrence estimates the information a term carries about a kind of entity,

    PMI(term, kind) = log2 P(kind | term) / P(kind),   IC(kind) = log2 1 / P(kind),

where P(kind | term) is the share of all the corpus' occurrences of the term that lie in such contexts.  A
term that carries at least ``disclosure`` of the kind's whole information, around enough different entities, is
a span of its own where it stands beside one.  The same measure over whole texts, PMI(term, entity) against the information of
the single entity, finds the words that give ONE entity away, such as a name that comes with a person's address: these
are spans wherever they occur in texts that hold the entity.  Entities are generalised to their kind, disclosing terms removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .store import freeze, small

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = "[A-Za-z0-9._%+-]"
# A match can only begin where a run of its signs begins, or at the end of the match before: a search
# stays linear in a text's length, whatever the text.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_MAY = {"email": "@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"(?:[0-9][\x20-]?){11}[0-9]", "phone": r"\+[0-9]"}
REACH = 64
TERMS = 3
SUPPORT = 5
#: Tables are broadcast up to so many bytes.
BROADCAST_BYTES = 16 << 20
DISCLOSURE = 0.9
_WORD_BREAK = r"[\s.,;:!?()\[\]\"']+"
_TERM = r"^\p{L}{3,40}$"
# A pair seen in one text alone tells nothing: there every word is as exclusive as the name.
PAIR_TEXTS = 2
_WORD = r"[^\s.,;:!?()\[\]\"']+"
_NAME = r"^\p{L}[\p{L}\p{M}-]{0,38}\p{L}$"
_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda x: x.cast("int"))
    worth = F.transform(d, lambda x, i: F.when(i % 2 == 1, F.when(x > 4, 2 * x - 9).otherwise(2 * x)).otherwise(x))
    return F.aggregate(worth, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: p.rlike(r"^0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]|)$"))
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _located(text: Column, pattern: str, code: int, valid) -> Column:
    """Spans of the valid matches: the pieces between matches give their places, in code points."""
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("s"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(a, x):
        begin = a["at"] + F.length(x["s"])
        end = begin + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(code).alias("kind"), end.alias("end"))
        return F.struct(end.cast("bigint").alias("at"), F.when(x["m"].isNotNull() & valid(x["m"]), F.concat(a["out"], F.array(span).cast(_SPAN))).otherwise(a["out"]).alias("out"))

    return F.aggregate(parts, start, step, lambda a: a["out"])


def base_spans(text: Column) -> Column:
    """Sorted spans ``(start, kind, end)`` of all entities of a text; only texts that may hold a kind are searched for it."""
    none = F.array().cast(_SPAN)
    found = [F.when(text.rlike(_MAY[k]), _located(text, PATTERNS[k], i, lambda m, k=k: _valid(k, m))).otherwise(none)
             for i, k in enumerate(KINDS[:4])]
    return F.sort_array(F.concat(*found))


def of_kind(code: int):
    return lambda x: x["kind"] == code


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")


def _context_terms(text: Column, span: Column) -> Column:
    """Lower-cased words beside a span with their places: at most three whole ones on each side, within 64 code points."""
    begin = F.greatest(span["start"] - REACH, F.lit(0)).cast("int")
    left = F.substring(text, begin + 1, (span["start"] - begin).cast("int"))
    right = F.substring(text, (span["end"] + 1).cast("int"), F.lit(REACH))
    word = r"[^\s.,;:!?()\[\]\"']+"
    yes = lambda m: m.rlike(_TERM)
    # A word that the edge of the context cuts, or that touches the entity, is not a whole one.
    lefts = F.filter(_located(left, word, 4, yes), lambda x: ((x["start"] > 0) | (begin == 0)) & (x["end"] < span["start"] - begin))
    rights = F.filter(_located(right, word, 4, yes), lambda x: (x["start"] > 0) & ((x["end"] < REACH) | (F.length(right) < REACH)))
    take = F.concat(F.transform(F.slice(F.reverse(lefts), 1, TERMS), lambda x: F.struct(
        F.lower(F.substring(left, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))).alias("term"),
        (x["start"] + begin).alias("start"), (x["end"] + begin).alias("end"))),
        F.transform(F.slice(rights, 1, TERMS), lambda x: F.struct(
            F.lower(F.substring(right, (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))).alias("term"),
            (x["start"] + span["end"]).alias("start"), (x["end"] + span["end"]).alias("end"))))
    return take


def disclosing_spans(docs: DataFrame, text: str = "text", disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``(text_key, terms)``: the term spans of every text that has some; ``text_key`` is the text's SHA-256.

    Contexts are counted over all rows, entities distinctly, so a copied text adds no support.  The
    corpus count covers every occurrence of the candidate terms in all texts.  Terms that disclose a single entity need no support
    of other entities; see :func:`_entity_places`.
    """
    src = docs.select(F.coalesce(docs[text], F.lit("")).alias("text"))
    # Texts with entities, found once.
    holds = freeze(src.where(" or ".join(f"text rlike r'{_MAY[k]}'" for k in _MAY)).withColumn("spans", base_spans(F.col("text")))
                   .where(F.size("spans") > 0).withColumn("text_key", F.sha2("text", 256)), "holds")
    beside = (holds.withColumn("x", F.explode("spans"))
              .select("text_key", F.col("x.kind").alias("kind"),
                      F.xxhash64(F.substring("text", (F.col("x.start") + 1).cast("int"), (F.col("x.end") - F.col("x.start")).cast("int"))).alias("entity"),
                      F.explode(_context_terms(F.col("text"), F.col("x"))).alias("t"))
              .select("text_key", "kind", "entity", "t.term", F.col("t.start").alias("start"), F.col("t.end").alias("end")))
    beside = freeze(beside, "contexts")
    seen = beside.groupBy("kind", "term").agg(F.count("*").alias("n_beside"), F.countDistinct("entity").alias("n_entities"))
    candidates = freeze(seen.where(F.col("n_entities") >= support), "candidates")
    per_kind = beside.groupBy("kind").agg(F.count("*").alias("n_kind"))
    words = src.select(F.split(F.lower("text"), _WORD_BREAK).alias("w"))
    terms = candidates.select("term").distinct()
    in_corpus = (words.select(F.explode("w").alias("term")).join(small(terms, 200_000), "term", "left_semi")
                 .groupBy("term").agg(F.count("*").alias("n_term")))
    total = words.agg(F.sum(F.size("w"))).first()[0] or 1
    p_kind = F.col("n_kind") / F.lit(float(total))
    pmi = F.log2(F.least(F.lit(1.0), F.col("n_beside") / F.col("n_term")) / p_kind)
    telling = (candidates.join(in_corpus, "term").join(F.broadcast(per_kind), "kind")  # one row per kind
               .where(pmi >= F.lit(disclosure) * F.log2(1 / p_kind)).select("kind", "term"))
    places = beside.join(telling, ["kind", "term"]).select("text_key", "start", "end").unionByName(_entity_places(src, holds, disclosure))
    return (places.groupBy("text_key")
            .agg(F.sort_array(F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end"))).cast(_SPAN).alias("terms")))


def _entity_places(src: DataFrame, holds: DataFrame, disclosure: float) -> DataFrame:
    """``(text_key, start, end)`` of all occurrences of terms that disclose an entity which the text holds.

    All counts are of different texts: a row counts as one part in as many as repeat its text, so that copies need not be brought
    together.  Entities and terms of a single text are no pairs.
    """
    keyed = src.withColumn("text_key", F.sha2("text", 256))
    copies = freeze(keyed.groupBy("text_key").agg(F.count("*").alias("n")), "copies")
    n_texts = copies.count() or 1
    repeated = small(copies.where("n > 1"), 200_000)
    share = (1 / F.coalesce("n", F.lit(1))).alias("w")
    hashed = F.array_distinct(F.transform("spans", lambda x: F.xxhash64(
        x["kind"], F.lower(F.substring("text", (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))))))
    entities = freeze(holds.select("text_key", F.explode(hashed).alias("entity")).distinct(), "entities")
    recurring = freeze(entities.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= PAIR_TEXTS), "recurring")
    of_text = freeze(entities.join(small(recurring.select("entity"), 200_000), "entity", "left_semi"), "text_entities")
    # Words of the texts with recurring entities, outside of the entities.
    outside = F.regexp_replace(sanitised(F.col("text"), F.col("spans")), r"\[(EMAIL|IP|CARD|PHONE)\]", " ")
    terms = F.array_distinct(F.filter(F.split(F.lower(outside), _WORD_BREAK), lambda t: t.rlike(_NAME)))
    with_any = small(of_text.select("text_key").distinct(), 200_000)
    own = freeze(holds.join(with_any, "text_key", "left_semi").join(repeated, "text_key", "left")
                 .select("text_key", share, F.explode(terms).alias("term")).groupBy("text_key", "term").agg(F.sum("w").alias("w")), "own")
    pairs = freeze(own.join(of_text, "text_key").groupBy("term", "entity").agg(F.round(F.sum("w")).alias("n_both"))
                   .where(F.col("n_both") >= PAIR_TEXTS), "pairs")
    wanted = pairs.select("term").distinct()
    every = keyed.join(repeated, "text_key", "left").select(share, F.explode(F.array_distinct(F.split(F.lower("text"), _WORD_BREAK))).alias("term"))
    if wanted.limit(200_001).count() <= 200_000:
        every = every.join(F.broadcast(wanted), "term", "left_semi")
    # Otherwise all words are counted (tasks combine first): that moves far less than their occurrences.
    in_texts = every.groupBy("term").agg(F.round(F.sum("w")).alias("n_term"))
    p = F.col("n_entity") / F.lit(float(n_texts))
    pmi = F.log2(F.least(F.lit(1.0), F.col("n_both") / F.col("n_term")) / p)
    telling = freeze(pairs.join(in_texts, "term").join(recurring, "entity")
                     .where((p < 1) & (pmi >= F.lit(disclosure) * F.log2(1 / p))).select("entity", "term"), "telling")
    # A text's own terms meet its own entities, so an entity of many texts brings none of the others' terms along.
    marked = freeze(own.join(telling.select("term").distinct(), "term", "left_semi").join(of_text, "text_key").join(telling, ["entity", "term"], "left_semi")
                    .groupBy("text_key").agg(F.collect_set("term").alias("names")), "names")
    place = F.explode(F.filter(_located(F.col("text"), _WORD, 4, lambda m: F.array_contains("names", F.lower(m))),
                               lambda x: ~F.exists("spans", lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"]))))
    size = marked.agg(F.sum(F.lit(100) + F.aggregate("names", F.lit(0), lambda a, t: a + F.length(t) * 4 + 16))).first()[0] or 0  # bytes at most
    return (holds.join(F.broadcast(marked) if size <= BROADCAST_BYTES else marked, "text_key").select("text_key", place.alias("x"))
            .select("text_key", F.col("x.start").alias("start"), F.col("x.end").alias("end")))


def find(docs: DataFrame, keep=("doc_id",), text: str = "text", disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``(*keep, base, spans)`` of every row: entity spans, and these with the disclosing terms.

    Null texts are empty and hold nothing.  Rows may repeat (each keeps its own result); only ``keep`` and the text are read, so
    extra columns cannot clash.  Narrow rows alone meet in the join by text hash unless ``keep`` names the text.
    """
    body = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(*[docs[c].alias(f"__k{i}") for i, c in enumerate(keep)], base_spans(body).alias("base"),
                       F.sha2(body, 256).alias("text_key"))
    terms = freeze(disclosing_spans(docs, text, disclosure, support), "terms")
    held = terms.agg(F.sum(F.lit(160) + 40 * F.size("terms"))).first()[0] or 0  # bytes: a key of 64 signs, spans of 24 bytes, overheads
    found = rows.join(F.broadcast(terms) if held <= BROADCAST_BYTES else terms, "text_key", "left")
    none = F.array().cast(_SPAN)
    return found.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], "base",
                        F.when(F.col("terms").isNull(), F.col("base"))
                        .otherwise(F.sort_array(F.concat("base", F.coalesce("terms", none)))).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with entities generalised to ``[KIND]`` and disclosing terms removed; of overlapping spans the
    first is replaced and the rest of the others dropped with it."""
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS[:4]], F.lit(""))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a, x):
        gap = F.substring(text, (a["at"] + 1).cast("int"), F.greatest(x["start"] - a["at"], F.lit(0)).cast("int"))
        put = F.when(x["start"] >= a["at"], F.get(labels, x["kind"])).otherwise(F.lit(""))
        return F.struct(F.greatest(a["at"], x["end"]).alias("at"), F.concat(a["out"], F.array(gap, put)).alias("out"))

    return F.when(F.size(spans) > 0, F.aggregate(
        spans, zero, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))).otherwise(text)
