"""Personal data: loose candidates, gradient-boosted trees over format and context, calibrated threshold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jsonloom.operators.ordering import running_totals
from jsonloom.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
#: the base patterns, written so that no search goes back over a long run (same matches: a run is entered at its start or
#: where the last match ended, and what nothing can follow is never given back)
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: high-recall candidates: other separators, missing signs, numbers out of range
LOOSE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}{{1,64}}+ ?(?:@|[(\[]at[)\]]) ?{LABEL}{{1,63}}+(?: ?(?:\.|[(\[]dot[)\]]) ?{LABEL}{{1,63}}+){{1,8}}+",
    "ip": r"(?<![0-9])[0-9]{1,4}(?: ?\. ?[0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{3,6}(?:[ ._/-]?[0-9]){9,15}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9])",
}
#: matches whose places are summed up together, and characters of a text that are cut out at once
GROUP, PIECE = 256, 64
#: what a text must hold before a kind is looked for
SIGNS = {"email": r"@|[(\[]at[)\]]", "ip": r"[0-9]", "card": r"[0-9]", "phone": r"[0-9]"}
#: words just before a span that speak for a kind
CUES = "(?i)(mail|contact|write|call|phone|tel|mobile|fax|card|visa|pay|account|host|server|addr|ip)[a-z.:-]* *$"
FEATURES = (
    "kind_no", "n_chars", "n_digits", "n_letters", "n_spaces", "n_dots", "n_dashes", "n_groups", "longest_group", "first_group", "brackets",
    "cue", "space_before", "space_after", "letter_before",
)


@dataclass(frozen=True)
class Settings:
    """``trees`` of a ``depth``, fitted on all known cases but the fifth that sets the threshold; ``precision``: what spans
    above the threshold must reach there."""

    trees: int = 12
    depth: int = 3
    precision: float = 0.98


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def found(text: Column, pattern: str, sign: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, value>>, in code points, end exclusive.

    The text between the matches and the matches themselves give all places without a second search. Places are summed up
    in groups of GROUP matches and then over the groups, so the work stays in proportion to a text with many matches.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(values)).alias("gap"), values.alias("value"))

    def in_group(group: Column) -> Column:
        """The group's length of text, and its matches with places from its start."""
        return F.aggregate(
            group,
            F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda s, p: F.struct(
                (s["at"] + p["gap"] + F.length(p["value"])).alias("at"),
                F.concat(
                    s["out"],
                    F.array(F.struct((s["at"] + p["gap"]).alias("start"), (s["at"] + p["gap"] + F.length(p["value"])).alias("end"), p["value"].alias("value"))),
                ).alias("out"),
            ),
        )

    def placed(all_pairs: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(all_pairs), F.lit(1)), F.lit(GROUP))
        groups = F.transform(firsts, lambda i: in_group(F.slice(all_pairs, i, GROUP)))

        def shifted(listed: Column) -> Column:
            begins = F.aggregate(
                listed,
                F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                lambda s, g: F.struct((s["at"] + g["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
                lambda s: s["out"],
            )
            move = lambda g, at: F.transform(
                g["out"], lambda s: F.struct((s["start"] + at).alias("start"), (s["end"] + at).alias("end"), s["value"].alias("value"))
            )
            return F.flatten(F.zip_with(listed, begins, move))

        return let(groups, shifted)

    return F.when(text.rlike(sign) & text.rlike(pattern), let(pairs, placed)).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the Luhn check: from the right, every second one counts double, less 9 when above 9."""
    each = F.transform(F.split(F.reverse(number), ""), lambda d, i: (i % 2 + 1) * d.cast("int"))
    total = F.aggregate(F.filter(each, lambda x: x.isNotNull()), F.lit(0), lambda s, x: s + x - F.when(x > 9, 9).otherwise(0))
    return total % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        short = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(short, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255"))
    number = digits(value)
    if kind == "card":
        return F.length(number).between(13, 19) & luhn(number)
    return F.length(number).between(9, 15)


def strict(kind: str, value: Column) -> Column:
    """Whether a candidate is the kind's base form and passes its check."""
    return value.rlike(f"^(?:{BASE[kind]})$") & valid(kind, value)


def plain(kind: str, value: Column) -> Column:
    """A candidate in its base form as far as its signs tell: written-out signs and spaces around signs replaced."""
    if kind == "email":
        return F.regexp_replace(F.regexp_replace(value, r" ?(?:@|[(\[]at[)\]]) ?", "@"), r" ?(?:\.|[(\[]dot[)\]]) ?", ".")
    if kind == "ip":
        return F.regexp_replace(value, " ", "")
    return F.regexp_replace(value, "^00", "+") if kind == "phone" else value


def passes(kind: str, value: Column) -> Column:
    """Whether a candidate passes what can be checked of its kind in any form; numbers of other kinds, dates, number runs
    that count up and sentence ends do not."""
    base = plain(kind, value)
    if kind == "email":
        return base.rlike(r"\.[A-Za-z]{2,24}$") & ~value.rlike(r"[^ ]\. +[A-Z]")
    if kind == "ip":
        parts = F.split(base, r"\.")
        return valid(kind, base) & ~F.forall(F.sequence(F.lit(1), F.lit(3)), lambda i: F.get(parts, i).cast("int") == F.get(parts, i - 1).cast("int") + 1)
    if kind == "card":
        return valid(kind, base)
    other = strict("ip", value) | strict("card", value) | value.rlike(r"^(19|20)[0-9]{2}[./-][01]?[0-9][./-][0-3]?[0-9]|^[0-3]?[0-9][./-][01]?[0-9][./-](19|20)[0-9]{2}")
    return valid(kind, base) & ~other


def rewritten(kind: str, value: Column, chance: Column) -> Column:
    """A base form as people also write it; ``chance`` selects the form."""
    join = lambda parts, by: F.call_function("array_join", parts, by)
    pick = lambda salt, *forms: F.element_at(F.array(*[F.lit(f) for f in forms]), F.pmod(F.xxhash64(chance, F.lit(salt)), F.lit(len(forms))).cast("int") + 1)
    if kind == "email":
        local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
        return F.concat(local, pick(1, " (at) ", "(at)", " [at] ", "[at]", " @ "), join(F.split(domain, r"\."), pick(2, ".", " (dot) ", "(dot)", "[dot]", " . ")))
    if kind == "ip":
        return join(F.split(value, r"\."), pick(1, " . ", ". ", " ."))
    if kind == "card":
        return join(F.regexp_extract_all(digits(value), F.lit("[0-9]{1,4}"), F.lit(0)), pick(1, ".", "_", "/", " ", "-", ""))
    groups = F.filter(F.split(value, "[^0-9]+"), lambda g: g != "")
    joined = join(groups, pick(2, " ", "-", ".", "/"))
    tail = F.regexp_replace(value, r"^\+", "")
    return (
        F.when(pick(1, 0, 1, 2, 3, 4) == 0, joined).when(pick(1, 0, 1, 2, 3, 4) == 1, F.concat(F.lit("00"), joined)).when(pick(1, 0, 1, 2, 3, 4) == 2, F.concat(F.lit("00"), tail))
        .when(pick(1, 0, 1, 2, 3, 4) == 3, tail).otherwise(F.regexp_replace(value, r"^\+[0-9]{1,3}[ .-]+", ""))
    )


def around(pieces: Column, s: Column) -> tuple[Column, Column]:
    """The 24 characters before a span and the one behind it, from a text in pieces of PIECE characters."""
    at = F.floor(s["start"] / PIECE).cast("int")
    piece = lambda i: F.coalesce(F.when(i >= 0, F.get(pieces, i)), F.lit(""))
    near = F.concat(piece(at - 1), piece(at))
    place = s["start"] - F.greatest(at - 1, F.lit(0)) * PIECE
    before = F.substring(near, F.greatest(place - 23, F.lit(1)), F.least(s["start"], F.lit(24)))
    return before, F.substring(piece(F.floor(s["end"] / PIECE).cast("int")), s["end"] % PIECE + 1, F.lit(1))


def described(kind: str, pieces: Column, s: Column, doc: Column, made: bool = False) -> Column:
    """A candidate with its features, or (``made``) a base form rewritten in its place, as a known case.

    ``label`` is 1 for rewritten base forms, 0 for candidates that fail their check and for numbers without a sign or a
    cue before them where a phone has no check but its length, else null: base forms are known anyway and all others are
    what the trees are to tell. ``stands``: of ten digit runs one passes the Luhn check, so nine that fail stand for one.
    ``open``: the candidate can be added. No feature restates the base form or the check.
    """
    before, after = around(pieces, s)

    def with_value(b: Column) -> Column:
        chance = F.xxhash64(b, s["value"])
        value = rewritten(kind, s["value"], chance) if made else s["value"]
        return let(value, lambda v: _described(kind, s, doc, made, b, after, chance, v))

    return let(before, with_value)


def _described(kind: str, s: Column, doc: Column, made: bool, before: Column, after: Column, chance: Column, value: Column) -> Column:
    count = lambda p: F.length(F.regexp_replace(value, p, "")).cast("double")
    groups = F.filter(F.split(value, "[^A-Za-z0-9]+"), lambda g: g != "")
    flag = lambda c: c.cast("int").cast("double")
    cue = before.rlike(CUES)
    features = {
        "kind_no": F.lit(float(KINDS.index(kind))), "n_chars": F.length(value).cast("double"), "n_digits": count("[^0-9]"), "n_letters": count("[^A-Za-z]"),
        "n_spaces": count("[^ ]"), "n_dots": count("[^.]"), "n_dashes": count("[^-]"), "n_groups": F.size(groups).cast("double"),
        "longest_group": F.array_max(F.transform(groups, F.length)).cast("double"), "first_group": F.length(F.get(groups, F.lit(0))).cast("double"),
        "brackets": flag(value.contains("(")), "cue": flag(cue),
        "space_before": flag(before.rlike("(^|[ \\t\\r\\n])$")), "space_after": flag(after.rlike("^([ \\t\\r\\n]|$)")), "letter_before": flag(before.rlike("\\p{L}$")),
    }
    fails = ~passes(kind, value)
    if made:
        whole = value.rlike(f"^(?:{LOOSE[kind]})$") & ~fails
        label, stands, ready = F.when(whole, 1), F.lit(1.0), F.lit(False)
    else:
        known = strict(kind, value)
        run = ~cue & ~value.startswith("+") if kind == "phone" else F.lit(False)
        label = F.when(~known & (fails | run), 0)
        stands = F.lit(1 / 9) if kind == "card" else F.lit(1.0)
        ready = ~known & ~fails
    return F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), label.cast("int").alias("label"), stands.alias("stands"), ready.alias("open"),
        chance.alias("chance"),
        *[F.coalesce(features[f], F.lit(0.0)).alias(f) for f in FEATURES],
    )


def numbered(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text``; a row's number holds for this reading of the table, so write it down before it is read again."""
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def candidates(text: DataFrame) -> DataFrame:
    """``row, doc_id, base, loose``: the base spans and the candidates (with features; base forms also rewritten) of every
    numbered text, in one pass."""
    spans = text.select(
        "row", "doc_id", F.when(F.col("text").rlike("[0-9@]|" + SIGNS["email"]), F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % PIECE), F.lit(0))).alias("pieces"),
        *[found(F.col("text"), BASE[k], SIGNS[k] if k != "phone" else r"\+[0-9]").alias(f"base_{k}") for k in KINDS],
        *[found(F.col("text"), LOOSE[k], SIGNS[k]).alias(f"loose_{k}") for k in KINDS],
    )
    kept = [
        F.transform(
            F.filter(f"base_{k}", lambda s: valid(k, s["value"])),
            lambda s: F.struct(F.lit(i).alias("order"), s["start"].alias("start"), s["end"].alias("end")),
        )
        for i, k in enumerate(KINDS)
    ]
    loose = [F.transform(f"loose_{k}", lambda s: described(k, F.col("pieces"), s, F.col("doc_id"))) for k in KINDS]
    loose += [
        F.transform(F.filter(f"loose_{k}", lambda s: strict(k, s["value"])), lambda s: described(k, F.col("pieces"), s, F.col("doc_id"), made=True)) for k in KINDS
    ]
    return spans.select("row", "doc_id", F.concat(*kept).alias("base"), F.concat(*loose).alias("loose"))


def fit(rows: DataFrame, s: Settings) -> tuple[GBTClassificationModel | None, float]:
    """The trees and the threshold, from all known cases; no model where the table has none of either class to fit.

    A fifth of the cases, by a hash, is held out for the threshold: the lowest probability from which on the likelier
    ones reach the precision.
    """
    each = rows.select(F.explode("loose").alias("c")).select("c.*").where("label is not null")
    cases = cut_lineage(
        each.select(
            F.col("label").cast("double").alias("label"), F.col("stands").alias("weight"), (F.pmod("chance", F.lit(5)) == 0).alias("held"), *FEATURES
        )
    )
    if cases.where("not held").select("label").distinct().count() < 2:
        return None, 2.0
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(cases)
    model = GBTClassifier(maxIter=s.trees, maxDepth=s.depth, stepSize=0.3, maxBins=32, seed=10, weightCol="weight").fit(ready.where("not held"))
    tested = model.transform(ready.where("held")).select("label", "weight", (-vector_to_array("probability")[1]).alias("down"))
    # one row per probability, then sums along them that no task holds whole
    steps = tested.groupBy("down").agg(F.sum(F.col("label") * F.col("weight")).alias("right"), F.sum("weight").alias("all"))
    sums = running_totals(steps, [], ["down"], {"right_before": F.col("right"), "all_before": F.col("all")})
    precision = (F.col("right_before") + F.col("right")) / (F.col("all_before") + F.col("all"))
    lowest = sums.where(precision >= s.precision).agg(F.max("down").alias("down")).first().down
    return model, 2.0 if lowest is None else max(0.5, -lowest)


def find_pii(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per document: ``row, doc_id, base, spans``, arrays of (order, start, end), order being the kind's place in
    KINDS; ``spans`` has the base spans and what the trees add, sorted.

    The generators propose overlapping spans; the trees score each from its format and the text around it; those at or
    over the threshold are taken, the likeliest first, where they overlap no span taken before nor any base span.
    Texts are read once; their spans go to the shared folder, and from there on only spans are handled. Null texts count
    as empty and have no spans; rows equal in all columns stay rows of their own; an empty table gives no rows; other
    columns are not read.
    """
    return _found(cut_lineage(candidates(numbered(docs))), s)


def _found(rows: DataFrame, s: Settings) -> DataFrame:
    model, threshold = fit(rows, s)
    if model is None:
        return rows.select("row", "doc_id", "base", F.array_sort("base").alias("spans"))
    each = rows.where(F.size("loose") > 0).select("row", F.explode("loose").alias("c")).select("row", "c.*").where("open")
    ready = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(each)
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    likely = model.transform(ready).select("row", vector_to_array("probability")[1].alias("p"), order.alias("order"), "start", "end").where(F.col("p") >= threshold)
    likely = cut_lineage(likely)
    more = added(likely, rows.join(likely.select("row").distinct(), "row", "left_semi"))
    spans = F.concat("base", F.coalesce("more", F.array().cast("array<struct<order:int,start:int,end:int>>")))
    return rows.select("row", "doc_id", "base").join(more, "row", "left").select("row", "doc_id", "base", F.array_sort(spans).alias("spans"))


def added(likely: DataFrame, rows: DataFrame) -> DataFrame:
    """``row, more``: of the likely spans of each text the likeliest first, where none taken before nor a base span overlaps.

    In order of their starts, running ends tell the spans that meet a base span, and part the others into runs that overlap; only
    inside a run does the order of taking matter, and runs are short however many spans a text has.
    """
    base = rows.select("row", F.explode("base").alias("b")).select("row", F.lit(None).cast("double").alias("p"), "b.order", "b.start", "b.end")
    both = likely.unionByName(base).withColumn("known", F.col("p").isNull())
    place = Window.partitionBy("row").orderBy("start", F.desc("known"))
    up, down = place.rowsBetween(Window.unboundedPreceding, 0), place.rowsBetween(0, Window.unboundedFollowing)
    # rows that begin where this one does may come before or behind it
    ends, starts = F.max(F.when(F.col("known"), F.col("end"))).over(up), F.min(F.when(F.col("known"), F.col("start"))).over(down)
    free = both.withColumns({"ends": ends, "starts": starts}).where("not known and (ends is null or ends <= start) and (starts is null or starts >= end)")
    order = Window.partitionBy("row").orderBy("start", "end", "order", F.desc("p"))
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = free.withColumn("opens", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    runs = opens.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("p"), "start", "end", "order")))
    apart = lambda a, b: (a["end"] <= b["start"]) | (b["end"] <= a["start"])
    none = F.array().cast("array<struct<order:int,start:int,end:int>>")
    taken = F.aggregate(
        "listed",
        none,
        lambda got, c: F.when(
            F.forall(got, lambda g: apart(g, c)),
            F.concat(got, F.array(F.struct(c["order"].alias("order"), c["start"].alias("start"), c["end"].alias("end")))),
        ).otherwise(got),
    )
    chosen = runs.groupBy("row", "run").agg(listed.alias("listed")).select("row", taken.alias("taken"))
    return chosen.groupBy("row").agg(F.flatten(F.collect_list("taken")).alias("more"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The texts with every span replaced by its kind in brackets: ``row, doc_id, text``; null texts stay null."""
    texts = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    by_start = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["order"].alias("order"))))
    state = F.aggregate(
        by_start,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    a["out"], F.substring(F.col("text"), a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0))),
                    F.when(s["start"] >= a["at"], F.element_at(names, s["order"] + 1)).otherwise(""),
                ).alias("out"),
            )
        ),
    )
    full = texts.withColumn("text", F.coalesce("text", F.lit("")))
    done = _found(cut_lineage(candidates(full)), s).join(texts.select("row", "text"), "row").withColumn("state", state)
    rest = F.substring(F.col("text"), F.col("state.at") + 1, F.length("text"))
    return done.select("row", "doc_id", F.concat(F.col("state.out"), rest).alias("text"))
