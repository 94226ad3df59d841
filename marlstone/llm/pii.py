"""Information-theoretic sanitisation of personal data, JVM expressions only.

Base kinds (email, ip, card, phone) are patterns with checks.  Their values are the
protected entities.  Over the different texts of the corpus, so that copies of a document
tell nothing new, the joint counts of entities e and terms t are taken twice:

* near: W words, n(t) words, n(e) spans, n(e, t) spans with t within ``REACH`` words of them;
* text: N different texts for W, and n(t), n(e) and n(e, t) texts, however far apart e and t stand.

    PMI(e; t) = ln(n(e, t) W / (n(e) n(t))),   IC(e) = ln(W / n(e)),

and IC - PMI = -ln(n(e, t) / n(t)) is what stays unknown of e for a reader who sees t.  Of a
few counts that is no more than a guess, so n(e, t) / n(t) is taken at the lower end of its
95 % interval (Wilson): a term that was seen once and next to e leaves 2.28 bits, twice 1.55,
six times 0.71.  A term discloses e when it leaves at most ``bits`` bits, and never more
than ``share`` of IC(e).  So an entity that is seen once is served too, by the words near it
that stand nowhere else; far from it a second text is needed, as in one text alone every
rare word would be telling.  Neither depends on the size of the corpus.  A disclosing term is generalised to [TERM] in every
document, also where only the term gives e away, and removed from ``remove_bits`` down.

Spans are code points, end exclusive.  Positions come from the gaps and the matches of
one and the same pattern, by prefix sums; texts are cut by blocks, so that many spans in a
long text cost no more than their number.  Nothing is lost to a limit: entities that stand
in exactly the same texts are counted as one, which changes no count.

Defined results: null text counts as empty (no spans) and stays null; rows with a null
doc_id, repeated rows and ties are treated like others; a value that fails its check is no
entity and gives no span; an empty table gives no row; columns of the input that are named
like those made here (``text`` and ``n_chars`` apart) come back unchanged from ``sanitise``.
The spans are listed by kind (email, ip, card, phone, then ``term`` and ``removed`` in one
list) and by start inside a kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Tidy, cut, free_name, hinted, let, text_of, words_of

KINDS = ("email", "ip", "card", "phone")
#: Words on either side of a span that are near it.
REACH = 8
#: A term that was seen once, and next to the entity, leaves 2.28.
BITS = 2.3
REMOVE_BITS = 0.75
SHARE = 0.35
_Z2 = 1.96**2
BLOCK = 1024
_TRIM = ".,;:!?()[]\"'"
_EDGE = r"\s.,;:!?()\[\]\"'"

#: A run that fails fails from each of its later characters too, so a match may only begin
#: where a run begins or the last match ended; that keeps long runs linear.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Text that must be there for a kind to occur at all.
_HINTS = {"email": "@", "phone": "+", "ip": "."}


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]+", "")


def _byte(part: Column) -> Column:
    bare = F.ltrim(part, F.lit("0"))
    return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)


_CHECKS = {
    "email": lambda x: F.lit(True),
    "ip": lambda x: F.forall(F.split(x, r"\."), _byte),
    "card": lambda x: let(_digits(x), lambda d: F.length(d).between(16, 19) & F.call_function("luhn_check", d)),
    "phone": lambda x: F.length(_digits(x)).between(8, 15),
}
_SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def _before(steps: Column, more) -> Column:
    """``more`` folded from 0 over what stands before each element, in blocks of the root of the length."""
    grow = lambda a: F.aggregate(
        a, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(more(F.element_at(acc, -1), x)))
    )

    def blocked(a: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(a))).cast("int")
        blocks = let(
            width,
            lambda w: F.transform(F.sequence(F.lit(0), F.ceil(F.size(a) / w).cast("int") - 1), lambda b: F.slice(a, b * w + 1, w)),
        )

        def joined(parts: Column) -> Column:
            whole = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), more))
            return F.flatten(
                F.zip_with(
                    parts,
                    F.slice(grow(whole), 1, F.size(parts)),
                    lambda p, base: F.transform(F.slice(grow(p), 1, F.size(p)), lambda v: more(base, v)),
                )
            )

        return let(blocks, joined)

    return F.when(F.size(steps) == 0, F.array().cast("array<int>")).otherwise(let(steps, blocked))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _most(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def find_spans(text: Column, kind: str, pattern: Column, check) -> Column:
    """Array of (kind, start, end, value) of the matches that pass ``check``."""

    def placed(m: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            steps = F.zip_with(gaps, m, lambda g, x: g + F.length(x))

            def build(before: Column) -> Column:
                starts = F.zip_with(before, gaps, lambda b, g: b + g)
                return F.filter(
                    F.zip_with(
                        starts,
                        m,
                        lambda s, x: F.struct(
                            F.lit(kind).alias("kind"), s.alias("start"), (s + F.length(x)).alias("end"), x.alias("value")
                        ),
                    ),
                    lambda span: check(span["value"]),
                )

            return let(_before(steps, _plus), build)

        gaps = F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(m)), F.length)
        return F.when(F.size(m) == 0, F.array().cast(_SPAN)).otherwise(let(gaps, with_gaps))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), placed).cast(_SPAN)


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with an array column _<kind> for each base kind."""
    text = text_of(docs)
    out = {}
    for kind in KINDS:
        spans = find_spans(text, kind, F.lit(PATTERNS[kind]), _CHECKS[kind])
        hint = _HINTS.get(kind)
        out[f"_{kind}"] = F.when(F.contains(text, F.lit(hint)), spans).otherwise(F.array().cast(_SPAN)) if hint else spans
    return docs.withColumns(out)


def _entity(span: Column) -> Column:
    value = F.when(span["kind"] == "email", F.lower(span["value"])).when(span["kind"] == "ip", span["value"])
    return F.concat_ws(":", span["kind"], value.otherwise(_digits(span["value"])))


def _term(word: Column) -> Column:
    return F.lower(F.btrim(word, F.lit(_TRIM)))


def _is_term(term: Column) -> Column:
    return term.rlike(r"^\p{L}[\p{L}\p{N}_-]{2,}$")


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


# -- replacing spans -----------------------------------------------------------------
def _cut(blocks: Column, a: Column, b: Column) -> Column:
    """Code points [a, b) of a text that is cut into blocks."""
    first, last = F.floor(a / BLOCK).cast("int"), F.floor(b / BLOCK).cast("int")
    inside = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    end = F.when(last > first, F.substring(F.coalesce(F.get(blocks, last), F.lit("")), F.lit(1), b % BLOCK)).otherwise(F.lit(""))
    return F.when(b <= a, F.lit("")).otherwise(F.concat(F.substring(F.get(blocks, first), a % BLOCK + 1, b - a), inside, end))


def ordered(spans: Column) -> Column:
    """Spans by start, the longer first, each with the furthest end before it."""

    def with_ends(s: Column) -> Column:
        return F.zip_with(
            s,
            _before(F.transform(s, lambda x: -x["back"]), _most),
            lambda x, before: F.struct(x["start"].alias("start"), (-x["back"]).alias("end"), x["kind"].alias("kind"), x["value"].alias("value"), before.alias("before")),
        )

    sort = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"), s["value"].alias("value")))
    )
    return let(sort, with_ends)


def replaced(text: Column, found: Column, label) -> Column:
    """``text`` with the spans of :func:`ordered` replaced; of overlapping ones the first names the label."""
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def build(parts: Column) -> Column:
        def pieces(spans: Column) -> Column:
            each = F.transform(
                spans, lambda s: F.when(s["start"] >= s["before"], F.concat(_cut(parts, s["before"], s["start"]), label(s))).otherwise(F.lit(""))
            )
            end = F.array_max(F.transform(spans, lambda s: s["end"]))
            return F.concat(F.array_join(each, ""), _cut(parts, end, F.length(text)))

        return let(found, pieces)

    return let(blocks, build)


# -- joint counts --------------------------------------------------------------------
def left_bits(n_et: Column, n_t: Column) -> Column:
    """Bits of the entity that the term leaves unknown: -log2 of the lower bound of n_et / n_t."""
    n = n_t.cast("double")
    p = F.least(n_et / n, F.lit(1.0))
    low = (p + _Z2 / (2 * n) - F.sqrt(_Z2 * (p * (1 - p) / n + _Z2 / (4 * n * n)))) / (1 + _Z2 / n)
    return -F.log2(low)


def _possible(pairs: DataFrame, said: DataFrame, bits: float) -> DataFrame:
    """The different (term, n_et, n_e) of ``pairs``, but for terms that are too common in ``said`` alone, a part of all."""
    least = said.groupBy("term").agg(F.count("*").alias("least"))
    fit = pairs.select("term", "n_et", "n_e").distinct().join(least, "term")
    return fit.where(left_bits(F.col("n_et"), F.greatest("least", "n_et")) <= bits + 1e-9).drop("least")


def near_pairs(texts: DataFrame, reach: int, bits: float) -> DataFrame:
    """(term, n_et, n_e) with n_et spans of an entity within ``reach`` words of the term.

    Spans that overlap are one place; they are not words of their own.
    """
    mark = "\x01"
    plain = F.translate(F.col("_text"), mark, " ")

    def held(words: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i) == mark)

        def windows(places: Column) -> Column:
            heads = F.transform("_spans", lambda s: (s["start"] >= s["before"]).cast("int"))
            place = F.zip_with(_before(heads, _plus), heads, lambda b, own: F.get(places, b + own - 1))
            return F.zip_with("_spans", place, lambda s, p: F.struct(_entity(s).alias("entity"), around(p).alias("terms")))

        def around(p: Column) -> Column:
            low = F.greatest(p - reach, F.lit(0))
            return F.array_distinct(F.filter(F.transform(F.slice(words, low + 1, p + reach - low + 1), _term), _is_term))

        return let(at, windows)

    marked = words_of(replaced(plain, F.col("_spans"), lambda s: F.lit(f" {mark} ")))
    found = cut(texts.select(F.explode(let(marked, held)).alias("x")).select("x.*"), "pii-held")
    often = found.groupBy("entity").agg(F.count("*").alias("n_e")).where("n_e > 1")
    together = found.select("entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("n_et"))
    pairs = together.join(hinted(cut(often, "pii-often"), F.length("entity") + 64), "entity", "left").withColumn("n_e", F.coalesce("n_e", F.lit(1)))
    said = texts.select(F.explode(words_of(F.col("_text"))).alias("word")).select(_term(F.col("word")).alias("term"))
    return _possible(pairs, said, bits)


def text_pairs(texts: DataFrame, bits: float) -> DataFrame:
    """(term, n_et, n_e) with n_et different texts that hold both, for two texts or more.

    Entities of the same texts are one: ``group``
    is a sum over their texts' hashes.
    """
    held = texts.select("_digest", F.explode(F.array_distinct(F.transform("_spans", _entity))).alias("entity"))
    where = F.xxhash64("_digest").cast("decimal(38,0)")
    strong = held.groupBy("entity").agg(F.count("*").alias("n_e"), F.sum(where).alias("group")).where("n_e > 1")
    strong = cut(strong, "pii-strong")
    groups = held.join(hinted(strong, F.length("entity") + 64), "entity").groupBy("_digest").agg(F.collect_set(F.struct("group", "n_e")).alias("groups"))
    terms = F.array_distinct(F.filter(F.transform(F.array_distinct(words_of(F.col("_text"))), _term), _is_term))
    rows = texts.join(groups, "_digest").select("groups", F.explode(terms).alias("term"))
    pairs = rows.select("term", F.explode("groups").alias("g")).groupBy("term", "g").agg(F.count("*").alias("n_et"))
    pairs = pairs.select("term", "n_et", F.col("g.n_e").alias("n_e"))
    return _possible(pairs.where("n_et > 1"), texts.select(F.explode(terms).alias("term")), bits)


def disclosing_terms(
    docs: DataFrame, texts: DataFrame, reach: int, bits: float, remove_bits: float, share: float
) -> DataFrame | None:
    """(_digest, term, removed) of every text with a disclosing term; None where there is none.

    ``texts`` has a row (_digest, _text, _spans) for each different text with a span.
    """
    text = text_of(docs)
    copies = docs.groupBy(_digest(text).alias("_digest")).agg(
        F.count("*").alias("copies"), F.max(F.size(words_of(text))).alias("n_words")
    )
    copies = cut(copies, "pii-copies")
    n_texts, n_words = copies.agg(F.count("*"), F.sum("n_words")).first()
    near = near_pairs(texts, reach, bits).withColumn("whole", F.lit(False))
    far = text_pairs(texts, bits).withColumn("whole", F.lit(True))
    pairs = cut(near.unionByName(far), "pii-pairs")
    terms = cut(pairs.select("term").distinct(), "pii-terms")
    if terms.isEmpty():
        return None
    said = docs.select(_digest(text).alias("_digest"), F.explode(words_of(text)).alias("word"))
    said = said.select("_digest", _term(F.col("word")).alias("term"))
    said = said.join(hinted(terms, F.length("term") + 64), "term", "left_semi")
    said = said.groupBy("_digest", "term").agg(F.count("*").alias("n"))
    said = said.join(copies.where("copies > 1").drop("n_words"), "_digest", "left")
    said = cut(said.select("_digest", "term", F.expr("n div coalesce(copies, 1)").alias("n")), "pii-said")
    often = said.groupBy("term").agg(F.sum("n").alias("n_words"), F.count("*").alias("n_texts"))
    w = F.when(F.col("whole"), F.lit(float(n_texts))).otherwise(F.lit(float(n_words or 0)))
    n_t = F.when(F.col("whole"), F.col("n_texts")).otherwise(F.col("n_words"))
    most = F.least(F.lit(bits), share * F.log2(w / F.col("n_e")))
    left = pairs.join(often, "term").withColumn("left", left_bits(F.col("n_et"), n_t)).withColumn("most", most)
    told = left.where(F.col("left") <= F.col("most") + 1e-9).groupBy("term").agg(F.min("left").alias("left"))
    told = cut(told, "pii-disclosing")
    told = said.join(hinted(told, F.length("term") + 64), "term")
    return told.select("_digest", "term", (F.col("left") <= remove_bits).alias("removed"))


def _told_spans(text: Column, terms: Column) -> Column:
    """Spans of the words of ``text`` that are in ``terms`` (term, removed), looked up by hash."""

    def looked_up(buckets: Column) -> Column:
        def kind(word: Column) -> Column:
            own = F.filter(F.get(buckets, F.pmod(F.xxhash64(word), F.size(buckets)).cast("int")), lambda t: t["term"] == word)
            return F.when(F.size(own) > 0, F.when(F.get(own, 0)["removed"], F.lit("removed")).otherwise(F.lit("term")))

        words = find_spans(text, "term", F.lit(f"[^{_EDGE}]+"), lambda x: F.lit(True))
        named = F.transform(
            words, lambda s: F.struct(kind(F.lower(s["value"])).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"))
        )
        return F.filter(named, lambda s: s["kind"].isNotNull())

    n = F.ceil(F.sqrt(F.size(terms))).cast("int")
    buckets = F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.filter(terms, lambda t: F.pmod(F.xxhash64(t["term"]), n) == b))
    return let(buckets, looked_up)


def find_personal_data(
    docs: DataFrame,
    reach: int = REACH,
    bits: float = BITS,
    remove_bits: float = REMOVE_BITS,
    share: float = SHARE,
) -> DataFrame:
    """``docs`` with _email, _ip, _card, _phone and _term arrays of spans, which replace columns of these names.

    The kind of a term's span is ``term`` (generalise) or ``removed``.
    """
    rows = base_spans(docs)
    every = F.concat(*(F.col(f"_{k}") for k in KINDS))
    key = {"_digest": _digest(text_of(docs)), "_text": text_of(docs), "_spans": ordered(every)}
    texts = rows.where(F.size(every) > 0).select(*(value.alias(name) for name, value in key.items()))
    none = F.array().cast(_SPAN)
    with Tidy() as tidy:
        texts = cut(texts.dropDuplicates(["_digest"]), "pii-texts")
        terms = disclosing_terms(docs, texts, reach, bits, remove_bits, share)
        if terms is None:
            return rows.withColumn("_term", none)
        by_text = terms.groupBy("_digest").agg(F.collect_list(F.struct("term", "removed")).alias("_terms"))
        by_text = cut(by_text, "pii-disclosed")
        tidy.keep(by_text)
    digest, told = free_name(rows, "_digest"), free_name(rows, "_terms")
    side = hinted(by_text.toDF(digest, told), 64 * F.size(told) + 128)
    joined = rows.withColumn(digest, _digest(text_of(docs))).join(side, digest, "left")
    spans = _told_spans(text_of(docs), F.col(told)).cast(_SPAN)
    return joined.withColumn("_term", F.when(F.col(told).isNull(), none).otherwise(spans)).drop(told, digest)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(found: DataFrame) -> DataFrame:
    """doc_id, counts by base kind, base_sha256 and the list of all spans."""
    base = F.concat(*(F.col(f"_{k}") for k in KINDS))
    counts = [F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *counts,
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.concat(base, F.col("_term"))).alias("spans"),
    )


def sanitise(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with personal data replaced in text, and n_chars to match where it is there.

    Of overlapping spans the first names the replacement, and all that they cover goes.
    """
    own = [c for c in docs.columns if c not in ("doc_id", "text")]
    # by place, so that no name of the caller's can clash
    slim = docs.select("doc_id", "text", F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(own))).alias("_own"))
    every = F.concat(*(F.col(f"_{k}") for k in (*KINDS, "term")))
    found = find_personal_data(slim, **options).withColumn("_text", text_of(slim))

    def label(s: Column) -> Column:
        return F.when(s["kind"] == "removed", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    clean = replaced(F.col("_text"), ordered(every), label)
    out = {c: F.col("_own").getField(f"c{k}") for k, c in enumerate(own)} | {
        "doc_id": F.col("doc_id"),
        "text": F.when(F.size(every) > 0, clean).otherwise(F.col("text")),
    }
    if "n_chars" in own:
        kind = dict(docs.dtypes)["n_chars"]
        out["n_chars"] = F.when(F.size(every) > 0, F.length(clean).cast(kind)).otherwise(out["n_chars"])
    return found.select(*(out[c].alias(c) for c in docs.columns))
