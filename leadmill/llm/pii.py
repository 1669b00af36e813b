"""Personal data in texts: fixed patterns, and more of the same kind by its context.

The fixed patterns find e-mail addresses, IP addresses, payment cards and phone numbers.
They are the seeds of a bootstrap: the words around a seed are lexical patterns, and other
spellings of an identifier (looser forms, which alone prove nothing) are candidates. The
patterns and instances form a graph. In each round a pattern is as reliable as the share of
its instances that are known to be of a kind, where seeds and candidates of other kinds
speak against it, and a candidate is believed if its patterns together are reliable enough. Believed candidates
count for their patterns in the next round.

Everything is a DataFrame or SQL function; no Python code runs on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadmill.llm.shared import stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 3
RELIABLE = 0.5
BELIEVED = 0.8
DOUBT = 2.0
#: How much a candidate of the same kind, not yet believed, speaks against a pattern.
OPEN = 0.25
# The patterns. Their quantifiers never give back, and they start at the
# start of a run of their characters or where the last match ended; both change no match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
    r"(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser forms that may be meant as an identifier of the kind.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}"
    r"(?:\x20?(?:\(at\)|\[at\]|\{at\})\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}"
    r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?|\x20dot\x20)[A-Za-z0-9-]{2,63}){1,5}",
    "ip": r"(?<![0-9A-Fa-f:.])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}:?[0-9A-Fa-f]{1,4}"
    r"|[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))\x20?[0-9]{1,3}){3})",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9+])\(?[0-9]{2,4}\)?(?:[\x20./-][0-9]{2,4}){1,4}(?![0-9])",
}
_SPAN = "struct<start:int,end:int,value:string,left:string,right:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits has a valid check digit."""
    backwards = F.reverse(digits)
    places = F.sequence(F.lit(1), F.length(digits))

    def part(place: Column) -> Column:
        digit = F.substring(backwards, place, F.lit(1)).cast("int")
        twice = 2 * digit
        return F.when(place % 2 == 1, digit).otherwise(
            F.when(twice > 9, twice - 9).otherwise(twice)
        )

    total = F.aggregate(F.transform(places, part), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda part: part.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"),
        )
    count = F.length(_digits(value))
    if kind == "card":
        # Long runs of digits are ruled out before their check digit is worked out.
        return F.when(count.between(12, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return count.between(9, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda x: _valid(kind, x["value"])


def _named(kind: str):
    """A span with the rank of its kind, in the order that spans are listed in."""
    return lambda x: F.struct(
        x["start"].alias("start"),
        F.lit(KINDS.index(kind)).alias("rank"),
        x["end"].alias("end"),
        F.lit(kind).alias("kind"),
        x["value"].alias("value"),
    )


def _is(kind: str):
    return lambda x: x["kind"] == kind


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def spans(text: Column, pattern: str) -> Column:
    """All matches of a pattern, leftmost and not overlapping, in order, with what is
    left and right of them: start and end count code points, the end is exclusive.

    The pieces between the matches and the matches alternate, which gives the places.
    """
    cut = F.struct(
        F.split(text, pattern, -1).alias("pieces"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
    )
    return _bound(cut, lambda cut: _bound(_matches(cut["pieces"], cut["found"]), _placed))


def _matches(pieces: Column, found: Column) -> Column:
    """The matches, each with the size of the piece before it and what is beside it."""
    return F.arrays_zip(
        found.alias("value"),
        F.transform(
            F.slice(pieces, 1, F.size(found)),
            lambda piece: F.struct(
                F.length(piece).alias("size"), F.right(piece, F.lit(60)).alias("tail")
            ),
        ).alias("before"),
        F.transform(
            F.slice(pieces, 2, F.greatest(F.size(found), F.lit(1))),
            lambda piece: F.left(piece, F.lit(40)),
        ).alias("after"),
    )


def _placed(rows: Column) -> Column:
    """The spans of matches in order.

    An array grows by being copied, so matches are placed in blocks of about the root of
    their number: first the blocks, by their sizes, then the matches of each.
    """
    size = F.ceil(F.sqrt(F.size(rows))).cast("int")
    last = (F.ceil(F.size(rows) / size) - 1).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), last), lambda n: F.slice(rows, n * size + 1, size)
    )

    def place(blocks: Column) -> Column:
        sizes = F.transform(
            blocks,
            lambda block: F.aggregate(
                block,
                F.lit(0),
                lambda at, row: at + row["before"]["size"] + F.length(row["value"]),
            ),
        )
        starts = F.aggregate(
            sizes,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda state, size: F.struct(
                (state["at"] + size).alias("at"),
                F.concat(state["out"], F.array(state["at"])).alias("out"),
            ),
            lambda state: state["out"],
        )
        parts = F.arrays_zip(blocks.alias("rows"), starts.alias("at"))
        return F.flatten(F.transform(parts, lambda part: _block(part["rows"], part["at"])))

    nothing = F.array().cast(f"array<{_SPAN}>")
    return F.when(F.size(rows) > 0, _bound(blocks, place)).otherwise(nothing)


def _block(rows: Column, at: Column) -> Column:
    """The spans of a few matches, the first piece of which begins at a place."""
    begin = F.struct(at.alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))

    def add(state: Column, row: Column) -> Column:
        start = state["at"] + row["before"]["size"]
        end = start + F.length(row["value"])
        span = F.struct(
            start.alias("start"),
            end.alias("end"),
            row["value"].alias("value"),
            row["before"]["tail"].alias("left"),
            row["after"].alias("right"),
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    return F.aggregate(rows, begin, add, lambda state: state["out"])


#: What a text must hold for a pattern to match at all.
_NEEDS = {
    ("email", True): r"@",
    ("ip", True): r"[0-9]\.[0-9]",
    ("card", True): r"[0-9]",
    ("phone", True): r"\+[0-9]",
    ("email", False): r"(?:[(\[{]|\x20)at(?:[)\]}]|\x20)",
    ("ip", False): r":[0-9A-Fa-f]{1,4}:|[0-9]\x20?[\[(]",
    ("card", False): r"[0-9]",
    ("phone", False): r"[0-9][0-9]",
}


def _found(text: Column, kind: str, base: bool) -> Column:
    pattern = (BASE if base else LOOSE)[kind]
    nothing = F.array().cast(f"array<{_SPAN}>")
    return F.when(text.rlike(_NEEDS[kind, base]), spans(text, pattern)).otherwise(nothing)


def _word(text: Column, pattern: str, group: int) -> Column:
    word = F.regexp_extract(text, pattern, group)
    return F.regexp_replace(F.lower(word), "[0-9]", "0")


def _occurrences(found: DataFrame) -> DataFrame:
    """One row for each span: ``row, kind, start, end, name, seed, patterns``.

    Spans of the loose patterns that overlap one of the fixed ones are left out. The spans
    of a text are sorted for that, and each is held against the base spans that begin
    before it and after it.
    """

    def listed(kind: str, base: bool) -> Column:
        column = f"{'base' if base else 'loose'}_{kind}"
        return F.transform(
            column,
            lambda x: F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("seed"), x.alias("x")),
        )

    rows = found.select(
        "row",
        F.explode(F.concat(*[listed(k, b) for k in KINDS for b in (True, False)])).alias("o"),
    ).select("row", "o.kind", "o.seed", "o.x.*")
    whole = (Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("row").orderBy("start").rangeBetween(*whole)
    after = Window.partitionBy("row").orderBy(F.desc("start")).rangeBetween(*whole)
    base_start, base_end = (F.when(F.col("seed"), F.col(name)) for name in ("start", "end"))
    clear = (F.coalesce(F.max(base_end).over(before), F.col("start")) <= F.col("start")) & (
        F.coalesce(F.min(base_start).over(after), F.col("end")) >= F.col("end")
    )
    rows = rows.withColumn("clear", clear).where("seed OR clear").drop("clear")
    first = _word(F.col("left"), r"(\S+)\s*$", 1)
    second = _word(F.col("left"), r"(\S+)\s+\S+\s*$", 1)
    after = _word(F.col("right"), r"^[^\p{L}\p{N}]*(\S+)", 1)
    patterns = F.array(
        F.concat(F.lit("1 "), first),
        F.concat(F.lit("2 "), second, F.lit(" "), first),
        F.concat(F.lit("3 "), first, F.lit(" _ "), after),
    )
    return rows.select(
        "row",
        "kind",
        "start",
        "end",
        "seed",
        F.lower(F.regexp_replace("value", r"\s+", " ")).alias("name"),
        F.when(first == "", F.array().cast("array<string>")).otherwise(patterns).alias("patterns"),
    )


def _reliability() -> Column:
    """Known instances of a kind against those of other kinds, and a part of the open ones."""
    known, same = F.col("known"), F.col("same")
    against = F.col("total") - same + OPEN * (same - known)
    return known / (known + against + DOUBT)


def _believed(
    occurrences: DataFrame, rounds: int, support: int, reliable: float, believed: float
) -> DataFrame:
    """``kind, name`` of the candidates that their contexts prove."""
    edges = stored(
        occurrences.select("kind", "name", "seed", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "kind", "name")
        .agg(F.max("seed").alias("seed"))
    )
    # All instances of a pattern, whatever their kind; equal values count once.
    totals = edges.groupBy("pattern").agg(F.count("*").alias("total"))
    belief = None
    for _ in range(rounds):
        if belief is None:
            scored = edges.withColumn("trust", F.col("seed").cast("double"))
        else:
            scored = edges.join(belief, ["kind", "name"], "left").withColumn(
                "trust",
                F.when(F.col("seed"), 1.0).otherwise(F.coalesce("belief", F.lit(0.0))),
            )
        rules = stored(
            scored.groupBy("pattern", "kind")
            .agg(
                F.sum("trust").alias("known"),
                F.count("*").alias("same"),
                F.sum(F.col("seed").cast("int")).alias("seeds"),
            )
            .where(F.col("seeds") >= support)
            .join(totals, "pattern")
            .select("pattern", "kind", _reliability().alias("rule"))
            .where(F.col("rule") >= reliable)
        )
        # Patterns that agree add up: what remains is the chance that all of them err.
        belief = stored(
            edges.where(~F.col("seed"))
            .join(rules, ["pattern", "kind"])
            .groupBy("kind", "name")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("rule"))))).alias("belief"))
            .where(F.col("belief") >= believed)
        )
    return belief.select("kind", "name")


def find_personal_data(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = ROUNDS,
    support: int = SUPPORT,
    reliable: float = RELIABLE,
    believed: float = BELIEVED,
) -> DataFrame:
    """``<id>, base, added`` of every row: arrays of ``start, end, kind, value``.

    ``base`` holds the matches of the fixed patterns, by start and then kind; ``added``
    what context adds, never overlapping base ones. Null and empty texts have none.
    Repeated rows each give a row.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    columns = {}
    for kind in KINDS:
        columns[f"base_{kind}"] = F.filter(
            _found(text, kind, True), _check(kind)
        )
        columns[f"loose_{kind}"] = _found(text, kind, False)
    columns["loose_phone"] = F.filter(
        columns["loose_phone"], lambda x: F.length(_digits(x["value"])).between(7, 15)
    )
    raw = docs.select(
        F.col(id_column).alias("id"), *[c.alias(name) for name, c in columns.items()]
    ).withColumn("row", F.monotonically_increasing_id())
    found = stored(raw)
    occurrences = stored(_occurrences(found))
    names = _believed(occurrences, rounds, support, reliable, believed)
    added = (
        occurrences.where(~F.col("seed"))
        .join(names, ["kind", "name"])
        .groupBy("row")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("start", "end", "kind", F.col("name").alias("value")))
            ).alias("added")
        )
    )
    base = F.transform(
        F.array_sort(
            F.concat(*[F.transform(f"base_{kind}", _named(kind)) for kind in KINDS])
        ),
        lambda x: F.struct(x["start"], x["end"], x["kind"], x["value"]),
    )
    nothing = F.array().cast("array<struct<start:int,end:int,kind:string,value:string>>")
    return found.join(added, "row", "left").select(
        F.col("id").alias(id_column),
        base.cast("array<struct<start:int,end:int,kind:string,value:string>>").alias("base"),
        F.coalesce("added", nothing).alias("added"),
    )


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts of base spans by kind, their checksum, and all spans as text."""

    def said(spans_column: Column) -> Column:
        parts = F.transform(
            spans_column,
            lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
        )
        return F.array_join(parts, ",")

    order = F.array(*[F.lit(kind) for kind in KINDS])
    everything = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda x: F.struct(
                x["start"].alias("start"),
                F.array_position(order, x["kind"]).alias("rank"),
                x["end"].alias("end"),
                x["kind"].alias("kind"),
            ),
        )
    )
    counts = [
        F.size(F.filter("base", _is(kind))).cast("long").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return found.select(
        id_column,
        *counts,
        F.sha2(said(F.col("base")), 256).alias("base_sha256"),
        said(everything).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
