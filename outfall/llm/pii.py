"""Personal data by weak supervision, in DataFrame functions alone.

Fixed patterns find the base spans, which always stay. Looser patterns find candidates. On every
span, base or not, labelers vote for (1), against (-1) or not at all (0): the pattern's own check, a
gazetteer, cue words in the context, and the characters at its edges. Expectation-maximisation
over the counts of vote patterns estimates how reliable each labeler is for each kind, and so how
likely each span is. A classifier over features that are not votes, the span's shape, length and
neighbours, is trained on these likelihoods, and adds the candidates that it is sure of.

A text's spans are rows after one scan of the texts. The table of vote patterns has 81 rows
per kind at most, that of the classifier ``BUCKETS`` per kind and feature.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outfall.llm.words import carried, restored, whole_text
from outfall.session import settle

KINDS = ["email", "ip", "card", "phone"]
#: Fixed patterns of the base spans. Possessive groups and the lookbehinds match the same spans as without them, in
#: linear time: a run of characters is not tried again from its middle unless a match ended there.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Patterns of the candidates. What they find counts only when the classifier is sure.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63})++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9])(?:[0-9]{4}(?:[\x20-][0-9]{4}){3}|[0-9]{13,19})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: Gazetteers, and cue words before or after a span (fixed values).
KNOWN = {
    "email": r"(?i)(?:\.|dot\)? ?)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$",
    "ip": r"^(?:[1-9][0-9]?|1[0-9][0-9]|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))",
    "phone": r"^\+(?:1|33|34|44|49)\b|^\(?[2-9][0-9]{2}\)?",
}
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|kontakt|courriel|correo|write)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|adresse|dirección)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|karte|carte|tarjeta|pay)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|telefon|téléphone|teléfono)\b",
}
AGAINST = r"(?i)(?:\b(?:version|release|isbn|order|section|chapter|page|figure|issue|build)\b[^\w]*|[#$€£v=])$"
LABELERS = ["v_check", "v_known", "v_cue", "v_edge"]
#: Iterations of the estimation between two writes, and how many such rounds.
STEPS, ROUNDS = 5, 3
#: The likelihood from which a candidate is added.
SURE = 0.95
#: Hash buckets for the values of a feature.
BUCKETS = 4096
_CONTEXT = 32


def _found(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """Matches of a pattern, in order, with what lies between them."""
    gaps = F.split(text, pattern, -1)
    # Zipped first: an array named inside the function would be made again for every element.
    zipped = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), gaps, F.slice(gaps, 2, 2**31 - 1))

    def row(parts: Column, i: Column) -> Column:
        hit, before, after = (parts[name] for name in "012")
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(base).alias("is_base"),
            i.alias("i"),
            F.length(before).cast("long").alias("gap"),
            hit.alias("hit"),
            F.substring(before, F.greatest(F.length(before) - (_CONTEXT - 1), F.lit(1)), F.lit(_CONTEXT)).alias("left"),
            F.substring(after, 1, _CONTEXT).alias("right"),
        )

    # There is one gap more than there are matches.
    return F.transform(F.filter(zipped, lambda parts: parts["0"].isNotNull()), row)


_ROW = "array<struct<kind:string,is_base:boolean,i:int,gap:bigint,hit:string,left:string,right:string>>"


def _matches(text: Column) -> Column:
    """All matches of all patterns. A pattern runs only over texts with a character that it needs."""
    nothing = F.array().cast(_ROW)
    needs = {"email": text.contains("@"), "ip": text.rlike("[0-9]\\.[0-9]"), "card": text.rlike("[0-9]"), "phone": text.contains("+")}
    loosely = {"email": text.rlike("(?:\\(at\\)|\\[at\\])"), "ip": needs["ip"], "card": needs["card"], "phone": needs["card"]}
    parts = [F.when(needs[k], _found(text, k, BASE[k], True)).otherwise(nothing) for k in KINDS]
    parts += [F.when(loosely[k], _found(text, k, LOOSE[k], False)).otherwise(nothing) for k in KINDS]
    return F.concat(*parts)


def _luhn(digits: Column) -> Column:
    reverse = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(reverse, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    # Only lengths that may pass are summed.
    return F.when(
        F.length(digits).between(13, 19),
        F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0,
    ).otherwise(False)


def _passes(kind: Column, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    part = F.regexp_replace(hit, "(^|\\.)0+(?=[0-9])", "$1")
    octets = part.rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", octets)
        .when(kind == "card", _luhn(digits))
        .otherwise(F.length(digits).between(9, 15))
    )


def _by_kind(kind: Column, values: dict[str, Column]) -> Column:
    return reduce(lambda chain, k: chain.when(kind == k, values[k]), KINDS[1:], F.when(kind == KINDS[0], values[KINDS[0]]))


def spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` (``row``, ``doc_id``), and all base spans and candidates with their votes."""
    rows = settle(
        docs.select("doc_id", whole_text(F.col("text")).alias("_text")).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", _matches(F.col("_text")).alias("_found")
        )
    )
    each = rows.filter(F.size("_found") > 0).select("row", F.explode("_found").alias("_s")).select("row", "_s.*")
    so_far = Window.partitionBy("row", "is_base", "kind").orderBy("i")
    placed = (
        each.withColumn("_length", F.length("hit").cast("long"))
        .withColumn("end", F.sum(F.col("gap") + F.col("_length")).over(so_far))
        .withColumn("start", F.col("end") - F.col("_length"))
        .withColumn("passes", _passes(F.col("kind"), F.col("hit")))
        # A match of a fixed pattern that fails its check is dropped, and is no candidate either.
        .filter(F.col("passes") | ~F.col("is_base"))
    )
    # A candidate that touches a base span is that span again.
    here = Window.partitionBy("row").orderBy("start", F.desc("is_base"), "end")
    earlier = F.max(F.when(F.col("is_base"), F.col("end"))).over(here.rowsBetween(Window.unboundedPreceding, 0))
    # The other way round, so that Spark adds each row to what it has instead of beginning anew for each.
    back = Window.partitionBy("row").orderBy(F.desc("start"), "is_base", F.desc("end"))
    later = F.min(F.when(F.col("is_base"), F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, 0))
    apart = (F.coalesce(earlier, F.lit(-1)) <= F.col("start")) & (F.coalesce(later, F.col("end")) >= F.col("end"))
    placed = placed.withColumn("_apart", apart).filter(F.col("is_base") | F.col("_apart"))
    kind, hit, left, right = (F.col(c) for c in ("kind", "hit", "left", "right"))
    against = left.rlike(AGAINST)
    near = F.concat_ws(" ", left, right)
    votes = {
        "v_check": F.when(F.col("passes"), 1).otherwise(-1),
        "v_known": F.when(_by_kind(kind, {k: hit.rlike(KNOWN[k]) for k in KINDS}), 1).otherwise(-1),
        "v_cue": F.when(against, -1).when(_by_kind(kind, {k: near.rlike(CUES[k]) for k in KINDS}), 1).otherwise(0),
        "v_edge": F.when(left.rlike(r"[\p{L}\p{N}]$") | right.rlike(r"^[\p{L}\p{N}]"), -1).otherwise(
            F.when(left.rlike(r"(?:^|\s)$") & right.rlike(r"^(?:$|[\s.,;:!?])"), 1).otherwise(0)
        ),
    }
    found = placed.select("row", "kind", "is_base", "start", "end", "hit", "left", "right", *[v.alias(n) for n, v in votes.items()])
    return rows.select("row", "doc_id"), settle(found)


def reliabilities(found: DataFrame) -> DataFrame:
    """For every kind and pattern of votes: ``likely``, the estimated share of true spans.

    Two classes are assumed whose labelers vote independently. The first guess is the majority of
    the votes, which also says which class is which. Counts are smoothed by one vote of each sort.
    """
    state = settle(found.groupBy("kind", *LABELERS).agg(F.count(F.lit(1)).cast("double").alias("_n")))
    votes = reduce(lambda a, b: a + b, [F.col(v) for v in LABELERS])
    state = state.withColumn("likely", 1 / (1 + F.exp(-votes.cast("double"))))
    mine = Window.partitionBy("kind")
    for _ in range(ROUNDS):
        state = state.coalesce(1)  # 81 rows per kind at most
        for _ in range(STEPS):
            state = state.withColumn("_yes", F.col("_n") * F.col("likely")).withColumn("_no", F.col("_n") - F.col("_yes"))
            odds = F.log((F.sum("_yes").over(mine) + 1) / (F.sum("_no").over(mine) + 1))
            for v in LABELERS:
                same = Window.partitionBy("kind", v)
                for side in ("_yes", "_no"):
                    share = (F.sum(side).over(same) + 1) / (F.sum(side).over(mine) + 3)
                    odds = odds + F.log(share) if side == "_yes" else odds - F.log(share)
            state = state.withColumn("likely", 1 / (1 + F.exp(-odds))).drop("_yes", "_no")
        state = settle(state)
    return state.select("kind", *LABELERS, "likely")


def _features() -> list[Column]:
    """Features of a span that are no votes: shape, length, and the characters around it."""
    shape = F.regexp_replace(F.regexp_replace("hit", r"\p{L}+", "a"), "[0-9]", "9")
    around = F.concat(F.substring("left", -1, 1), F.lit("_"), F.substring("right", 1, 1))
    outside = F.regexp_replace(F.regexp_replace(around, r"\p{L}", "a"), "[0-9]", "9")
    values = {"shape": shape, "length": F.length("hit").cast("string"), "outside": outside}
    return [F.struct(F.lit(n).alias("feature"), F.pmod(F.xxhash64(v), F.lit(BUCKETS)).alias("value")) for n, v in values.items()]


def classified(found: DataFrame, weights: DataFrame) -> DataFrame:
    """``found`` with ``probability`` by a naive Bayes classifier trained on the spans' likelihoods."""
    spans_with = found.join(F.broadcast(weights), ["kind", *LABELERS])  # 81 rows per kind at most
    features = spans_with.withColumn("_f", F.explode(F.array(*_features()))).select("row", "kind", "is_base", "start", "end", "likely", "_f.*")
    table = features.groupBy("kind", "feature", "value").agg(F.sum("likely").alias("_yes"), F.sum(1 - F.col("likely")).alias("_no"))
    whole = Window.partitionBy("kind", "feature")
    scored = settle(
        table.withColumn("_all_yes", F.sum("_yes").over(whole))
        .withColumn("_all_no", F.sum("_no").over(whole))
        .select(
            "kind", "feature", "value",
            F.log((F.col("_yes") + 0.5) / (F.col("_all_yes") + 0.5)).alias("_a"),
            F.log((F.col("_no") + 0.5) / (F.col("_all_no") + 0.5)).alias("_b"),
            F.log((F.col("_all_yes") + 0.5) / (F.col("_all_no") + 0.5)).alias("_prior"),
        )
    )
    odds = F.sum(F.col("_a") - F.col("_b")) + F.max("_prior")
    return (
        features.join(F.broadcast(scored), ["kind", "feature", "value"])  # BUCKETS per kind and feature at most
        .groupBy("row", "kind", "is_base", "start", "end")
        .agg((1 / (1 + F.exp(-odds))).alias("probability"))
    )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): its spans of personal data.

    Returns ``doc_id``, ``n_email``, ``n_ip``, ``n_card`` and ``n_phone`` (base spans),
    ``base_sha256``, ``spans`` (all spans as kind:start:end, by kind, then start; code points, end exclusive) and
    ``n_added``. Null texts count as empty; other columns are not read; repeated rows come back as often.
    """
    rows, found = spans(docs)
    sure = classified(found, reliabilities(found)).filter(F.col("is_base") | (F.col("probability") >= SURE))
    number = _by_kind(F.col("kind"), {k: F.lit(i) for i, k in enumerate(KINDS)})
    label = F.concat_ws(":", "kind", "start", "end")
    entry = F.struct(number.alias("n"), "start", "end", label.alias("label"))
    per_row = sure.groupBy("row").agg(
        *[F.count(F.when(F.col("is_base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS],
        F.sort_array(F.collect_list(F.when(F.col("is_base"), entry))).alias("_base"),
        F.sort_array(F.collect_set(entry)).alias("_all"),
        F.count(F.when(~F.col("is_base"), 1)).alias("n_added"),
    )

    def joined(name: str) -> Column:
        return F.coalesce(F.array_join(F.col(f"{name}.label"), ","), F.lit(""))

    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.join(per_row, "row", "left").select(
        "doc_id", *counts, F.sha2(joined("_base"), 256).alias("base_sha256"), joined("_all").alias("spans"),
        F.coalesce("n_added", F.lit(0)).cast("long").alias("n_added"),
    )


def redact(docs: DataFrame, marked: DataFrame, mark: str = "<{}>") -> DataFrame:
    """``docs`` with every span of ``marked`` (``doc_id`` unique, ``spans``) replaced by its kind."""
    cut = F.transform(F.filter(F.split("spans", ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    ordered = F.array_sort(F.transform(cut, lambda p: F.struct(p[1].cast("int").alias("s"), p[2].cast("int").alias("e"), p[0].alias("k"))))
    before, after = mark.split("{}")

    def step(state: Column, span: Column) -> Column:
        fresh = span["s"] >= state["at"]
        text = F.concat(
            state["text"], F.substring(F.col("text"), state["at"] + 1, span["s"] - state["at"]), F.lit(before), span["k"], F.lit(after)
        )
        return F.struct(F.when(fresh, text).otherwise(state["text"]).alias("text"), F.greatest(state["at"], span["e"]).alias("at"))

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    done = F.aggregate(ordered, start, step, lambda s: F.concat(s["text"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    rows = carried(docs).join(marked.select("doc_id", "spans"), "doc_id", "left")
    new = F.when(F.coalesce(F.col("spans"), F.lit("")) == "", F.col("text")).otherwise(done)
    return restored(rows.select(F.col("_whole").withField("text", new).alias("_whole")))
