"""Line dedup by content-defined chunks.

A document's lines are hashed, and a hash of two line hashes rolls over them, line by line. Where
its value occurs once in all documents, nothing around that place can be repeated, so a chunk
ends there; it also ends where the next value's first occurrence (lowest id, then position) is not
the next place after this one's. Between two such ends lies a chunk: a longest run of two lines or
more that stands, byte for byte and in one piece, at an earlier place too. Ends follow from the
lines alone, so a passage is found whole whatever stands before and after it, however many lines
it has. A chunk goes if it holds :data:`LEAST_WORDS` plain words, or as many letters and digits as
:data:`LEAST_LETTERS`; others, such as the closing lines of functions, a few imports or rules between
paragraphs, are no passages and stay.

Values count as equal only if the bytes of their two lines are: occurrences are grouped by hash
and text, counted in the map tasks, and a hash that stands for two texts is passed over. Equal
values with first occurrences side by side then make equal chunks.

Defined results: a null text is an empty one; an empty or one-line text stays as it is; a null id
sorts after all others; rows with the same id and text are one document and are treated alike; a
text with all lines removed is empty, its row stays, and blank lines that remain stay. Within one
document a copy goes too, but not where it overlaps its original. Columns keep their names, order
and other values. Ids are integers. What this cannot find: a single repeated line between others,
and copies that differ in every second line or break their lines elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held, once, written

#: What a chunk holds at least: words of letters between blanks, or letters and digits for scripts without
#: blanks and for long stretches of code.
LEAST_WORDS = 10
LEAST_LETTERS = 200
#: Lines that the rolling hash covers, and thus of a chunk at least.
WINDOW = 2
#: A plain word between doubled blanks; what is neither a letter nor a digit.
BLANK, WORD, OTHER = r"[ \t]", r" [\p{L}\p{M}]{2,}[.,;:!?]? ", r"[^\p{L}\p{N}]"
_LAST = (1 << 63) - 1
_PLACES = 1 << 31


def _occurrences(docs: DataFrame) -> DataFrame:
    """(id, version, pos, place, rolled, lines) of every two lines; pos is the first one's."""
    df = docs.select("id", "version", once(F.split("text", "\n", -1)).alias("lines"))
    df = df.select("*", once(F.transform("lines", lambda line: F.xxhash64(line))).alias("hashes"))
    count = F.size("lines") - 1
    own, after = (F.slice("lines", first, count) for first in (1, 2))
    rolled = F.zip_with(F.slice("hashes", 1, count), F.slice("hashes", 2, count), lambda a, b: F.xxhash64(a, b))
    both = F.zip_with(own, after, lambda a, b: F.concat(a, F.lit("\n"), b))
    pairs = F.zip_with(rolled, both, lambda value, lines: F.named_struct(F.lit("rolled"), value, F.lit("lines"), lines))
    found = df.select("id", "version", F.posexplode(pairs).alias("pos", "pair"))
    # 29 bits of the text's hash stand between id and position.
    below = F.pmod("version", F.lit(1 << 29)) * F.lit(_PLACES) + F.col("pos")
    order = F.coalesce("id", F.lit(_LAST)).cast("decimal(19,0)") * F.lit(1 << 60).cast("decimal(19,0)")
    return found.select(
        "id",
        "version",
        "pos",
        (order + below.cast("decimal(19,0)")).cast("decimal(38,0)").alias("place"),
        F.col("pair.rolled").alias("rolled"),
        F.col("pair.lines").alias("lines"),
    )


def repeated(places: DataFrame) -> DataFrame:
    """(rolled, first) of each value that occurs more than once, always over the same bytes."""
    texts = places.groupBy("rolled", "lines").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    values = texts.groupBy("rolled").agg(F.sum("n").alias("n"), F.count("*").alias("texts"), F.min("first").alias("first"))
    return values.where((F.col("n") > 1) & (F.col("texts") == 1)).select("rolled", "first")


def _chunks(hits: Column) -> Column:
    """(first line, last line) of each chunk, out of (pos, away) in order: ``away`` is the distance to the
    first occurrence, which stays the same as long as both sides go on side by side."""
    count = F.size(hits)
    none = F.array(F.lit(None).cast(_HIT))
    before = F.concat(none, F.slice(hits, 1, count - 1))
    after = F.concat(F.slice(hits, 2, count - 1), none)

    def goes_on(a: Column, b: Column) -> Column:
        return F.coalesce((b["pos"] == a["pos"] + 1) & (b["away"] == a["away"]), F.lit(False))

    starts = F.filter(F.zip_with(before, hits, lambda a, b: F.when(~goes_on(a, b), b["pos"])), lambda p: p.isNotNull())
    ends = F.filter(F.zip_with(hits, after, lambda a, b: F.when(~goes_on(a, b), a["pos"] + WINDOW - 1)), lambda p: p.isNotNull())
    return F.zip_with(starts, ends, lambda start, stop: F.named_struct(F.lit("start"), start, F.lit("stop"), stop))


def _content(line: Column) -> Column:
    spaced = F.concat(F.lit(" "), F.regexp_replace(line, BLANK, "  "), F.lit(" "))
    words = F.regexp_count(spaced, F.lit(WORD))
    return F.struct(words.alias("words"), F.length(F.regexp_replace(line, OTHER, "")).alias("letters"))


_HIT = "struct<pos: int, away: decimal(38,0)>"


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", removed: str | None = None) -> DataFrame:
    """``docs`` without repeated chunks; ``removed`` names a column for the number of lines that went."""
    body = F.coalesce(F.col(text), F.lit(""))
    keys = [F.col(id).cast("long").alias("id"), F.xxhash64(body).alias("version")]
    places = _occurrences(docs.select(*keys, body.alias("text")))
    away = (F.col("place") - F.col("first")).cast("decimal(38,0)")
    hits = (
        places.drop("lines")
        # Written apart from its grouping, so that the join can split lines that very many documents have.
        .join(written(repeated(places), "repeated"), "rolled")
        .where(F.col("place") >= F.col("first") + WINDOW)
        # Rows of the same id and text give the same hits.
        .groupBy(F.col("id").alias("of_id"), F.col("version").alias("of_version"))
        .agg(F.sort_array(F.collect_set(F.struct("pos", away.alias("away")).cast(_HIT))).alias("hits"))
    )
    others = docs.select(*[F.col(f"`{name}`") for name in docs.columns if name != text])
    base = docs.select(held(others).alias("row"), F.col(f"`{text}`").alias("text"), *keys)
    joined = base.join(hits, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("version") == F.col("of_version")), "left")
    df = joined.select("row", "text", once(F.when(F.col("hits").isNotNull(), F.split("text", "\n", -1))).alias("lines"), once(_chunks(F.col("hits"))).alias("chunks"))
    df = df.select("*", once(F.transform("lines", _content)).alias("content"))

    def whole(chunk: Column) -> Column:
        own = F.slice("content", chunk["start"] + 1, chunk["stop"] - chunk["start"] + 1)
        words, letters = (F.aggregate(own, F.lit(0), lambda total, line: total + line[kind]) for kind in ("words", "letters"))
        return (words >= LEAST_WORDS) | (letters >= LEAST_LETTERS)

    gone = F.flatten(F.transform(F.filter("chunks", whole), lambda c: F.sequence(c["start"], c["stop"])))
    df = df.select("row", "text", "lines", once(gone).alias("gone"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone")
    df = df.select("*", once(kept).alias("kept"))
    some = F.coalesce(F.size("gone") > 0, F.lit(False))
    rest = F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
    new = F.when(some, rest).otherwise(F.col("text")).alias(text)
    columns = [new if name == text else F.col(f"row.`{name}`").alias(name) for name in docs.columns]
    if removed:
        columns.append(F.when(some, F.size("lines") - F.size("kept")).otherwise(0).cast("long").alias(removed))
    return df.select(*columns)
