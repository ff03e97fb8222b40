"""Secret scan: fixed patterns, and windows of high entropy, as column expressions.

Fixed kinds (matches are leftmost and do not overlap within a kind): ``assign``, a name
such as ``token`` with a value of 12 or more characters; ``access``, an access-key id of
18 or more; ``hex``, 16 or more hexadecimal digits.

Entropy kinds: a candidate is a run of 20 or more characters of the Base64 alphabets with
a digit and a letter in it; it belongs to the class ``entropy_hex`` if all of it is
hexadecimal, else to ``entropy_base64``. A window of :data:`WINDOW` characters slides
over it. Entering and leaving characters change one count each, and with it the running
sum of ``c log2 c``, from which the window's Shannon entropy follows; sums are integers
(millionths of a bit), so no rounding depends on the order. The span reaches from the
first window at or above its class's threshold to the end of the last. Candidates that
match :data:`ALLOWED`, and spans within a fixed kind's span, are left out.

Defined results: a null text is an empty one and has no spans; positions are code
points, ends exclusive; every row gives one row, repeated rows alike; other columns stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held, once, released

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
ALL_HEX = "^[0-9A-Fa-f]+$"
MIXED = "(?=.*[0-9])(?=.*[A-Za-z])"
WINDOW = 20
#: Bits per character at which a window counts, by class.
BITS = {"entropy_hex": 3.0, "entropy_base64": 3.8}
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")
#: Candidates that are no secrets: UUIDs, words joined by signs, one sign repeated, runs of the alphabet, samples.
ALLOWED = (
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    "^[A-Za-z]+[0-9]{0,4}([/_=+-]+[A-Za-z]*[0-9]{0,4})+$",
    "0123456789|abcdefghij|ABCDEFGHIJ",
    "(?i)example|sample|placeholder|xxxxxx|000000",
)
_UNIT = 1_000_000


def weight(count: int) -> int:
    """``c log2 c`` in millionths."""
    return round(count * math.log2(count) * _UNIT) if count else 0


def limit(bits: float) -> int:
    """The largest sum of weights at which a window has ``bits`` per character."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * _UNIT)


def _located(matches: str, text: str, pattern: str) -> Column:
    """(start, end) of each of ``matches``, from the lengths of the pieces between them."""
    gaps = F.when(F.size(matches) > 0, F.slice(F.split(text, pattern, -1), 1, F.size(matches)))
    lengths = F.zip_with(matches, gaps, lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("size")))
    span = "struct<start:int,end:int>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        here = state["at"] + x["gap"]
        after = here + x["size"]
        found = F.struct(here.alias("start"), after.alias("end"))
        return F.struct(after.alias("at"), F.concat(state["spans"], F.array(found)).alias("spans"))

    spans = F.aggregate(lengths, start, step, lambda state: state["spans"])
    return F.when(F.size(matches) > 0, spans).otherwise(F.array().cast(f"array<{span}>"))


def _of_kind(spans: Column | str, kind: str) -> Column:
    """Spans with their kind and its rank, in the order they are listed in."""
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def _entropy_span(candidate: Column, most: Column) -> Column:
    """(first, last): where windows whose weights sum to ``most`` or less begin and end."""
    weights = F.array(*[F.lit(weight(c)).cast("long") for c in range(WINDOW + 1)])
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    gone = F.concat(F.array_repeat(F.lit(-1), WINDOW), codes)
    moves = F.zip_with(codes, F.slice(gone, 1, F.length(candidate)), lambda i, o: F.struct(i.alias("new"), o.alias("old")))
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.lit(0).cast("long").alias("sum"),
        F.lit(0).alias("at"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def count(state: Column, code: Column) -> Column:
        return F.get(state["counts"], code)

    def slide(state: Column, x: Column) -> Column:
        came, left = count(state, x["new"]), count(state, x["old"])
        more = F.get(weights, came + 1) - F.get(weights, came)
        less = F.when(x["old"] >= 0, F.get(weights, left) - F.get(weights, left - 1)).otherwise(F.lit(0).cast("long"))
        same = x["new"] == x["old"]
        return F.struct(
            F.when(same, state["counts"])
            .otherwise(
                F.transform(
                    state["counts"],
                    lambda n, i: n + F.when(i == x["new"], 1).when(i == x["old"], -1).otherwise(0),
                )
            )
            .alias("counts"),
            F.when(same, state["sum"]).otherwise(state["sum"] + more - less).alias("sum"),
            (state["at"] + 1).alias("at"),
            state["first"].alias("first"),
            state["last"].alias("last"),
        )

    def noted(state: Column) -> Column:
        hit = (state["at"] >= WINDOW) & (state["sum"] <= most)
        return F.struct(
            state["counts"].alias("counts"),
            state["sum"].alias("sum"),
            state["at"].alias("at"),
            F.coalesce(state["first"], F.when(hit, state["at"] - WINDOW)).alias("first"),
            F.when(hit, state["at"]).otherwise(state["last"]).alias("last"),
        )

    return F.aggregate(
        moves,
        start,
        # The sum seen at a step is that of the window before it; the last one is seen at the end.
        lambda state, x: slide(noted(state), x),
        lambda state: F.struct(noted(state)["first"].alias("start"), noted(state)["last"].alias("end")),
    )


def scan_secrets(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: (start, rank, end, kind) of every secret, in order of start and kind."""
    df = docs.select(held(docs).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = {
        "assigns": F.regexp_extract_all("text", F.lit(ASSIGN), 0),
        "values": F.regexp_extract_all("text", F.lit(ASSIGN), 2),
        "accesses": F.regexp_extract_all("text", F.lit(ACCESS), 0),
        "hexes": F.regexp_extract_all("text", F.lit(HEX), 0),
        "runs": F.regexp_extract_all("text", F.lit(CANDIDATE), 0),
    }
    df = df.select("*", once(F.struct(*[value.alias(name) for name, value in found.items()])).alias("found"))
    df = df.select("row", "text", "found.*")
    places = {
        "assign_at": _located("assigns", "text", ASSIGN),
        "access_at": _located("accesses", "text", ACCESS),
        "hex_at": _located("hexes", "text", HEX),
        "run_at": _located("runs", "text", CANDIDATE),
    }
    df = df.select("*", once(F.struct(*[value.alias(name) for name, value in places.items()])).alias("places"))
    df = df.select("row", "values", "runs", "places.*")

    valued = F.zip_with("assign_at", "values", lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), v.alias("value")))
    assigned = F.filter(valued, lambda s: F.length(s["value"]) >= ASSIGN_VALUE)
    fixed = F.concat(_of_kind(assigned, "assign"), _of_kind("access_at", "access"), _of_kind("hex_at", "hex"))

    allowed = F.lit("|".join(f"(?:{pattern})" for pattern in ALLOWED))
    runs = F.zip_with("runs", "run_at", lambda r, s: F.struct(r.alias("run"), s["start"].alias("start")))
    runs = F.filter(runs, lambda r: F.regexp_like(r["run"], F.lit(MIXED)) & ~F.regexp_like(r["run"], allowed))
    runs = F.transform(
        runs,
        lambda r: F.struct(
            r["run"].alias("run"), r["start"].alias("start"), F.regexp_like(r["run"], F.lit(ALL_HEX)).alias("hex")
        ),
    )
    df = df.select("row", once(F.struct(fixed.alias("fixed"), runs.alias("runs"))).alias("both")).select("row", "both.*")

    most = {kind: F.lit(limit(bits)).cast("long") for kind, bits in BITS.items()}
    windows = F.transform(
        "runs",
        lambda r: F.struct(
            r["start"].alias("base"),
            r["hex"].alias("hex"),
            _entropy_span(r["run"], F.when(r["hex"], most["entropy_hex"]).otherwise(most["entropy_base64"])).alias("span"),
        ),
    )
    df = df.select("row", "fixed", once(windows).alias("windows"))
    added = F.transform(
        F.filter("windows", lambda w: w["span"]["start"].isNotNull()),
        lambda w: F.struct(
            (w["base"] + w["span"]["start"]).alias("start"),
            F.when(w["hex"], KINDS.index("entropy_hex")).otherwise(KINDS.index("entropy_base64")).alias("rank"),
            (w["base"] + w["span"]["end"]).alias("end"),
            F.when(w["hex"], "entropy_hex").otherwise("entropy_base64").alias("kind"),
        ),
    )
    df = df.select("row", "fixed", once(added).alias("added"))
    fresh = F.filter(
        "added", lambda a: ~F.exists("fixed", lambda b: (b["start"] <= a["start"]) & (b["end"] >= a["end"]))
    )
    result = F.array_sort(F.concat("fixed", fresh))
    columns = [c for c, name in zip(released(df, "row"), docs.columns, strict=True) if name != spans]
    return df.select(*columns, result.alias(spans))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
