"""Filing text: cleaning, sections, chunks and lexicon tone. Whole texts throughout."""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions import constants as K
from riskweave.session import cut_lineage

# Unicode white space, as one character class
BLANK = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
# runs of white space that are not a single blank already
UNEVEN = rf" {BLANK}+|[{BLANK}&&[^ ]]{BLANK}*"
WORD = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
AT_ONCE = 32  # texts that are cut into chunks together
SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def strip_html(html: Column | str) -> Column:
    """Tags to spaces, the four common entities, white space collapsed."""
    text = F.regexp_replace(F.col(html) if isinstance(html, str) else html, r"<[^>]+>", " ")
    for entity, plain in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    return F.trim(F.regexp_replace(text, BLANK + "+", " "))


def clean(text: Column | str) -> Column:
    """White space collapsed, rules of underscores or hyphens dropped."""
    t = F.regexp_replace(F.col(text) if isinstance(text, str) else text, UNEVEN, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, "_{3,}", ""), "-{3,}", ""))


def word_count(text: Column | str) -> Column:
    return F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD))


def primary_link(html: Column | str) -> Column:
    """File name of the main document on a filing index page: the first pattern that matches."""
    h = F.col(html) if isinstance(html, str) else html
    found = F.coalesce(*[F.nullif(F.regexp_extract(h, "(?is)" + p, 1), F.lit("")) for p in K.PRIMARY_LINK_PATTERNS])
    return F.element_at(F.split(found, "/"), -1)


def _last_place(text: Column, part: Column) -> Column:
    """Zero-based place of the last occurrence of a part that is known to be there."""
    behind = F.call_function("substring_index", text, part, F.lit(-1))
    return F.char_length(text) - F.char_length(behind) - F.char_length(part)


def sections(docs: DataFrame, headings: Sequence[tuple[str, str, str]] = tuple(K.SECTIONS), max_chars: int | None = None, min_chars: int = 100) -> DataFrame:
    """One row per section: from the last match of its heading to the start of the next section.

    Texts without any heading give one row 'full'. `max_chars` caps a section's raw length; by
    default a section is taken whole.
    """
    low = docs.withColumn("_low", F.lower("text"))
    # one scan per heading finds its last match; its place is that of the matched text
    low = low.withColumns({f"_h_{key}": F.try_element_at(F.regexp_extract_all("_low", F.lit(pattern), F.lit(0)), F.lit(-1)) for key, pattern, _ in headings})
    marks = F.array_compact(F.array(*[
        F.when(
            F.col(f"_h_{key}").isNotNull(),
            F.struct(_last_place(F.col("_low"), F.col(f"_h_{key}")).alias("pos"), F.lit(key).alias("section_key"), F.lit(title).alias("section_name")),
        )
        for key, _, title in headings
    ]))
    others = [c for c in docs.columns if c != "text"]
    # the one-element explode keeps the planner from copying the scans into every later use
    found = low.select(*others, "text", F.explode(F.array(F.array_sort(marks))).alias("_m"))
    full = F.array(F.struct(F.lit(0).alias("pos"), F.lit("full").alias("section_key"), F.lit("Full Filing").alias("section_name")))
    stops = F.concat(F.slice("_m.pos", 2, F.greatest(F.size("_m"), F.lit(1))), F.array(F.char_length("text")))
    spans = F.arrays_zip(F.when(F.size("_m") > 0, F.col("_m")).otherwise(full).alias("s"), stops.alias("stop"))
    cut = found.select(*others, "text", F.size("_m").alias("_n"), F.inline(spans)).select(*others, "text", "_n", "s.*", "stop")
    length = F.col("stop") - F.col("pos")
    if max_chars is not None:
        length = F.least(length, F.lit(max_chars))
    raw = F.substring(F.col("text"), F.col("pos") + 1, length)
    # as above: the filter on its length would have every text cleaned twice
    whole = F.when(F.col("_n") > 0, clean(raw)).otherwise(raw)
    out = cut.select(*others, "_n", "section_key", "section_name", F.explode(F.array(whole)).alias("text"))
    return out.where((F.col("_n") == 0) | (F.char_length("text") >= min_chars)).select(*others, "section_key", "section_name", "text")


def _pieces(text: str, separator: str) -> list[str]:
    """Split with the separator kept at the head of the piece it starts."""
    if not separator:
        return list(text)
    first, *rest = text.split(separator)
    return [p for p in [first, *(separator + r for r in rest)] if p]


def _pack(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Runs of pieces up to `size`; the next run starts with the tail of the last, up to `overlap`."""
    ends = [0, *accumulate(map(len, pieces))]
    out, start, stop = [], 0, 0
    while True:
        # a run holds one piece or more, and as many as fit
        stop = max(bisect_right(ends, ends[start] + size) - 1, min(stop + 1, len(pieces)))
        out.append("".join(pieces[start:stop]).strip())
        if stop == len(pieces):
            return [c for c in out if c]
        tail = bisect_left(ends, max(ends[stop] - overlap, ends[stop + 1] - size))
        start = min(max(start, tail), stop)


def split_text(text: str, size: int = 1000, overlap: int = 200, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Recursive character splitting: the coarsest separator present is used, longer pieces go one level down."""
    level = next((i for i, s in enumerate(separators) if not s or s in text), len(separators) - 1)
    finer = separators[level + 1:]
    chunks, short = [], []
    pieces = _pieces(text, separators[level])
    if max(map(len, pieces), default=0) < size:
        return _pack(pieces, size, overlap)
    for piece in pieces:
        if len(piece) < size:
            short.append(piece)
            continue
        if short:
            chunks += _pack(short, size, overlap)
            short = []
        chunks += split_text(piece, size, overlap, finer) if finer else [piece]
    if short:
        chunks += _pack(short, size, overlap)
    return chunks


def cut_batches(batches: Iterator[pa.Array], size: int, overlap: int, separators: Sequence[str]) -> Iterator[pa.Array]:
    """Chunks of each text; Python holds the texts and chunks of a few rows, however many come in one batch."""
    for texts in batches:
        for i in range(0, len(texts), AT_ONCE):
            some = texts.slice(i, AT_ONCE).to_pylist()
            yield pa.array([split_text(t or "", size, overlap, separators) for t in some], pa.list_(pa.string()))


def chunks(sections_df: DataFrame, size: int = 1000, overlap: int = 200, separators: Sequence[str] = SEPARATORS) -> DataFrame:
    """One row per chunk with its index, the number of chunks and the source label."""
    seps = tuple(separators)

    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from cut_batches(batches, size, overlap, seps)

    others = [c for c in sections_df.columns if c != "text"]
    listed = sections_df.withColumn("_c", cut("text"))
    return with_chunk_labels(listed, "_c", others)


def stride_chunks(docs: DataFrame, size: int = 1000, overlap: int = 200) -> DataFrame:
    """Chunks of fixed length and stride, as column expressions only."""
    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(F.char_length("text") - 1, F.lit(0)), F.lit(step))
    others = [c for c in docs.columns if c != "text"]
    listed = docs.withColumn("_c", F.transform(starts, lambda s: F.substring(F.col("text"), s + 1, F.lit(size))))
    return with_chunk_labels(listed, "_c", others)


def with_chunk_labels(listed: DataFrame, column: str, others: Sequence[str]) -> DataFrame:
    source = F.concat_ws("_", *[c for c in ("ticker", "period_of_report", "section_key") if c in others])
    return listed.select(*others, F.size(column).alias("total_chunks"), source.alias("source"), F.posexplode(column).alias("chunk_index", "text"))


def _mentions(text: Column, phrases: Sequence[str]) -> list[Column]:
    """Occurrences of each phrase; a text is only taken apart for phrases that its bytes hold."""
    low = [p.lower() for p in phrases]
    return [F.when(F.contains(text, F.lit(p)), F.regexp_count(text, F.lit("\\Q" + p + "\\E"))).otherwise(0) for p in low]


def lexicon_scan(docs: DataFrame, risk: dict[str, list[str]] = K.RISK_PHRASES, positive: Sequence[str] = tuple(K.POSITIVE_PHRASES)) -> DataFrame:
    """Per text: phrases hit and mentions by category, positive mentions and words.

    Phrases that contain each other count twice.
    """
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    low = docs.withColumn("_low", F.lower("text"))
    low = low.withColumns({f"_{c}": F.array(*_mentions(F.col("_low"), ps)) for c, ps in risk.items()})
    add = lambda a, x: a + x
    out = low.withColumns({
        **{f"{c}_phrases": F.size(F.filter(f"_{c}", lambda n: n > 0)) for c in risk},
        **{f"{c}_mentions": F.aggregate(f"_{c}", F.lit(0), add) for c in risk},
        "positive_mentions": sum(_mentions(F.col("_low"), positive), F.lit(0)),
        "words": F.greatest(word_count("text"), F.lit(1)),
    })
    return out.drop("_low", "text", *[f"_{c}" for c in risk])


def tone(scan: DataFrame, risk: Sequence[str] = tuple(K.RISK_PHRASES)) -> DataFrame:
    """Scores and marks of a scan, per text or summed over texts."""
    total = sum((F.col(f"{c}_mentions") for c in risk), F.lit(0))
    out = scan.withColumn("total_risk_mentions", total)
    density = F.col("total_risk_mentions") / F.col("words") * 1000
    out = out.withColumns({
        "language_risk_score": F.least(F.lit(100.0), F.round(density * 8, 1)),
        "sentiment_ratio": F.round(F.col("positive_mentions") / F.greatest("total_risk_mentions", F.lit(1)), 2),
    })
    marks = {"going_concern_detected": ("going_concern", 0), "restatement_risk": ("restatement", 0), "legal_risk_detected": ("legal_risk", 1)}
    return out.withColumns({m: F.col(f"{c}_mentions") > n for m, (c, n) in marks.items() if c in risk})


def company_tone(docs: DataFrame, key: str, risk: dict[str, list[str]] = K.RISK_PHRASES) -> DataFrame:
    """Tone over all texts of a company: texts are scanned where they lie and only counts are combined."""
    scan = lexicon_scan(docs, risk)
    counts = [f"{c}_mentions" for c in risk] + ["positive_mentions", "words"]
    return tone(scan.groupBy(key).agg(F.count(F.lit(1)).alias("texts"), *[F.sum(c).alias(c) for c in counts]), list(risk))


def tone_sample(texts: DataFrame, keys: Sequence[str], order: Sequence[str], section: str = "risk_factors", chars: int = 3000, slices: int = 64) -> DataFrame:
    """The text that stands for a company's tone: its first section of the given kind, whole, else the start of all its texts.

    Texts follow `order`, which must tell the rows of a company apart, and are joined by a space; null texts are left out.
    Each joined text adds a character or more, so no more than `chars` + 1 of them are needed: they are found by slices of a
    company first, and only their starts are moved. Of the sections, places are compared and one text is fetched.
    """
    held = texts.where("text IS NOT NULL")
    place = F.struct(*order)
    # the starts are stored, so that whole texts are worked out once for them and once for the sections chosen
    kept = [*dict.fromkeys([*keys, *order, "section_key"])]
    short = cut_lineage(held.select(*kept, F.left("text", F.lit(chars)).alias("text")))
    chosen = short.where(F.col("section_key") == section).groupBy(*keys).agg(F.min(place).alias("_at")).select(*keys, "_at.*")
    whole = held.where(F.col("section_key") == section).join(chosen, [*keys, *order]).select(*keys, "text")
    starts = short.select(*keys, *order, "text").withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)))
    near = Window.partitionBy(*keys, "_slice").orderBy(*order)
    first = Window.partitionBy(*keys).orderBy(*order)
    few = starts.withColumn("_n", F.row_number().over(near)).where(F.col("_n") <= chars + 1)
    before = F.coalesce(F.sum(F.char_length("text") + 1).over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    used = few.withColumn("_before", before).where(F.col("_before") <= chars)
    joined = used.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, "text"))).alias("_t"))
    start = joined.select(*keys, F.left(F.array_join("_t.text", " "), F.lit(chars)).alias("_start"))
    both = start.join(whole, list(keys), "left")
    return both.select(*keys, F.when(F.col("text").isNull(), "start").otherwise(section).alias("sample_of"), F.coalesce("text", "_start").alias("sample"))


def unseen(chunks_df: DataFrame, indexed: DataFrame) -> DataFrame:
    """Chunks whose source is not in the index yet."""
    return chunks_df.join(indexed.select("source").distinct(), "source", "left_anti")


def index_stats(chunks_df: DataFrame) -> DataFrame:
    return chunks_df.agg(F.count(F.lit(1)).alias("total_chunks"), F.countDistinct("source").alias("sources"))


# tasks get these helpers with the job, so workers need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
