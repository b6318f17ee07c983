"""Personal data in texts, found with built-in functions and boosted trees.

Rules find what is certain (``RULES``): their spans always count. Generators of
high recall (``GENERATORS``) propose more, and proposals may overlap each other
and the rules' spans. Gradient-boosted trees score each proposal by its format
and its surroundings; a proposal above its kind's threshold, apart from all better ones
and from the rules' spans, is a span too.

The trees learn from weak labels. A proposal that meets a span of its kind's rule is
personal data, and one where that rule's pattern matched and its test refused is not. Others,
such as local numbers and written-out addresses, are in formats that no rule looks at: they have
no label and are not learned from, and no feature tells the rules' own signs. A secret has no rule; a word like
"token" before it makes it one, and that word is no feature. All labelled proposals of all
texts count, those alike in kind, features and label as one row with their number as its weight.
A fifth is held out: a threshold is the least score from which on nineteen of twenty of a kind
are right there, and any score above zero where that holds for all of a kind.

Fitted trees become SQL conditions, so every text is judged where it lies,
without a shuffle.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaportrail.llm.shared import table, written

# Rows that one task learns from. Up to that, sums run in one order, so every run grows the same trees.
TASK_ROWS = 500_000
KINDS = ("email", "ip", "card", "phone", "secret")

_MAIL = "A-Za-z0-9._%+-"
# Kind, what the text must hold for a look to be worthwhile, the spans, what must hold for one.
# A run of the leading class is tried from its beginning only, or from where the last
# match ended: later beginnings end alike. Repetition is possessive where what
# follows cannot need any of it back, so no text makes the matcher recurse or start over.
RULES = {
    "email": (
        "@",
        rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "true",
    ),
    "ip": (
        r"[0-9]\.[0-9]",
        r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
        "forall(split(x, '[.]'), p -> length(trim(leading '0' from p)) <= 3 and try_cast(right(p, 3) as int) <= 255)",
    ),
    "card": (r"[0-9][\x20-]?[0-9]", r"[0-9](?:[\x20-]?[0-9])++", "{luhn}"),
    "phone": (
        r"\+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        "length(regexp_replace(x, '[^0-9]', '')) between 9 and 15",
    ),
}
# Name: kind, need, pattern. Letters and digits around are for the trees to weigh.
GENERATORS = {
    "written_email": (
        "email",
        r"(?i)\bat\b|@",
        rf"(?i)(?<![{_MAIL}])[{_MAIL}]{{1,64}}(?:\s?@\s?|\s?[\[(]at[\])]\s?|\sat\s)[a-z0-9-]{{1,63}}(?:\.[a-z0-9-]{{1,63}}){{1,4}}",
    ),
    "dotted": ("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]{1,4}(?:\.[0-9]{1,4}){3}"),
    "digits": ("card", r"[0-9]{12}", r"(?<![0-9])[0-9]{12,20}(?![0-9])"),
    "grouped": (
        "card",
        r"[0-9]{4}[\x20-][0-9]{4}",
        r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])",
    ),
    "local_phone": (
        "phone",
        r"[0-9][\x20.-][0-9]",
        r"(?<![0-9])(?:\+?[0-9]{1,3}[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    ),
    "token": ("secret", r"[0-9A-Za-z_+/-]{20}", r"(?<![0-9A-Za-z_+/-])[0-9A-Za-z_+/-]{20,}+"),
}
_CUE = r"(?i)\b(?:token|secret|password|passwd|apikey|api[_-]?key|key)\W{0,4}$"
# Whole numbers 13 to 19 digits long with a right last digit.
_LUHN = (
    "transform(array(translate({x}, ' -', '')), d -> length(d) between 13 and 19 and d rlike '^[0-9]+$' and "
    "aggregate(sequence(1, least(length(d), 19)), 0, (s, i) -> s + "
    "if(i % 2 = 1, coalesce(try_cast(substr(d, -i, 1) as int), 0), "
    "coalesce(try_cast(substr(d, -i, 1) as int), 0) * 2 - if(substr(d, -i, 1) >= '5', 9, 0))) % 10 = 0)[0]"
)
_SPAN = "struct<start: int, stop: int, value: string>"
_NONE = f"cast(array() as array<{_SPAN}>)"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(need: str, pattern: str) -> str:
    """SQL for all matches in the text ``t``, leftmost first, none overlapping; code points."""
    pieces = (
        f"transform(array(split(t, {_quoted(pattern)}, -1)), g -> "
        f"transform(regexp_extract_all(t, {_quoted(pattern)}, 0), (x, i) -> "
        "struct(length(g[i]) as gap, length(x) as size, x as value)))[0]"
    )
    return (
        f"if(not t rlike {_quoted(need)}, {_NONE}, aggregate({pieces}, "
        f"named_struct('at', 0, 'out', {_NONE}), (s, p) -> named_struct('at', s.at + p.gap + p.size, 'out', "
        "concat(s.out, array(named_struct('start', s.at + p.gap, 'stop', s.at + p.gap + p.size, 'value', p.value)))), "
        "s -> s.out))"
    )


def _bound(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def rule_spans(text: str = "text", refused: bool = False) -> Column:
    """Struct of the rules' spans by kind, as arrays, or of the matches they refuse; null counts as empty."""
    fields = []
    for kind, (need, pattern, test) in RULES.items():
        test = test.replace("{luhn}", _LUHN.replace("{x}", "x"))
        test = f"not coalesce({test}, false)" if refused else test
        kept = f"filter({_matches(need, pattern)}, m -> {_bound('x', 'm.value', test)})"
        fields.append(f"'{kind}', {kept}")
    return F.expr(_bound("t", f"coalesce({text}, '')", f"named_struct({', '.join(fields)})"))


# Features of a proposal x before and after which ``before`` and ``after`` stand.
FEATURES = {
    "length": "length(x)",
    "digits": "length(regexp_replace(x, '[^0-9]', ''))",
    "letters": "length(regexp_replace(x, '[^A-Za-z]', ''))",
    "capitals": "length(regexp_replace(x, '[^A-Z]', ''))",
    "hexadecimal": "length(regexp_replace(x, '[^0-9a-fA-F]', ''))",
    "kinds_of_characters": "size(array_distinct(split(left(x, 4096), '')))",
    "luhn": f"cast({_LUHN.replace('{x}', 'x')} as int)",
    "small_parts": "cast(forall(split(x, '[^0-9]+'), p -> length(p) <= 3 and coalesce(try_cast(p as int), 0) <= 255) as int)",
    "brackets": "cast(x rlike '[()]' as int)",
    "spaces": "length(x) - length(replace(x, ' ', ''))",
    "quoted": "cast(before rlike '[\"\\'`]$' as int)",
    "after_sign": "cast(before rlike '[=:#/.-]\\\\s?$' as int)",
    "after_letter": "cast(before rlike '[A-Za-z]$' as int)",
    "after_digit": "cast(before rlike '[0-9]\\\\s?$' as int)",
    "before_letter": "cast(after rlike '^[A-Za-z]' as int)",
    "before_digit": "cast(after rlike '^\\\\s?[0-9]' as int)",
    "number_word": "cast(before rlike '(?i)(?:phone|tel|call|fax|mobile|card|visa|ip|mail|contact)\\\\W{0,3}$' as int)",
    "counting_word": "cast(before rlike '(?i)(?:version|section|chapter|page|isbn|issn|id|no)\\\\W{0,3}$' as int)",
}


def proposals(text: str = "text") -> Column:
    """All proposals of a text: kind, generator, place, features, and whether a cue stands before."""
    lists = []
    for number, (kind, need, pattern) in enumerate(GENERATORS.values()):
        features = ", ".join(f"'{name}', cast({value} as double)" for name, value in FEATURES.items())
        whole = (
            f"named_struct('kind', '{kind}', 'start', m.start, 'stop', m.stop, "
            f"'cue', before rlike {_quoted(_CUE)}, 'generator', {number}.0D, {features})"
        )
        whole = _bound("x", "m.value", whole)
        whole = _bound("before", "substr(t, greatest(1, m.start - 23), least(24, m.start))", whole)
        whole = _bound("after", "substr(t, m.stop + 1, 8)", whole)
        lists.append(f"transform({_matches(need, pattern)}, m -> {whole})")
    return F.expr(_bound("t", f"coalesce({text}, '')", f"concat({', '.join(lists)})"))


_INPUTS = ["generator", *FEATURES]


def _condition(lines: list[str]) -> str:
    """SQL of a printed tree."""
    line = lines.pop(0).strip()
    if found := re.match(r"Predict: (\S+)", line):
        return f"{found[1]}D"
    found = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
    low = _condition(lines)
    lines.pop(0)  # Else
    return f"if(p.{_INPUTS[int(found[1])]} <= {found[2]}D, {low}, {_condition(lines)})"


def _sum_of(model) -> str:
    trees = [_condition(tree.toDebugString.strip().splitlines()[1:]) for tree in model.trees]
    return " + ".join(f"{weight}D * {tree}" for weight, tree in zip(model.treeWeights, trees, strict=True))


def examples(documents: DataFrame) -> DataFrame:
    """All labelled proposals of all texts: ``kind``, whether ``held`` out, ``label``, the trees' inputs,
    and ``weight``, the number of proposals that agree in these."""
    rows = documents.select(
        F.xxhash64("doc_id", "text").alias("row"),
        F.explode(F.array(rule_spans())).alias("rules"),
        rule_spans(refused=True).alias("refused"),
        proposals().alias("proposals"),
    )
    rows = rows.where("size(proposals) > 0")
    rows = rows.select("row", "rules", "refused", F.explode("proposals").alias("p"))
    meets, fails = (
        " or ".join(f"(p.kind = '{kind}' and exists({of}.{kind}, r -> {_overlap('r', 'p')}))" for kind in RULES)
        for of in ("rules", "refused")
    )
    rows = rows.select(
        F.col("p.kind").alias("kind"),
        (F.pmod(F.xxhash64("row", "p.start", "p.generator"), F.lit(5)) == 0).alias("held"),
        F.expr(
            f"case when {meets} or (p.kind = 'secret' and p.cue) then 1D when p.kind = 'secret' or {fails} then 0D end"
        ).alias("label"),
        *(F.col(f"p.{name}").alias(name) for name in _INPUTS),
    ).where("label is not null")
    return rows.groupBy("kind", "held", "label", *_INPUTS).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def fitted(documents: DataFrame) -> tuple[str, dict[str, float]] | None:
    """The trees' sum as SQL over a proposal ``p``, and thresholds by kind."""
    known = written(examples(documents), "proposals")
    learned = known.where("not held")
    if learned.select("label").distinct().count() < 2:
        return None
    size = learned.count()
    learned = learned.coalesce(1) if size <= TASK_ROWS else learned.repartition(size // TASK_ROWS + 1, *_INPUTS)
    learned = learned.sortWithinPartitions("kind", "label", *_INPUTS)
    # With more rows than bins squared the learner would take a sample to find where to split.
    learner = GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxDepth=3, maxIter=8, stepSize=0.4, seed=1,
        checkpointInterval=-1, maxBins=max(32, math.isqrt(size) + 1),
    )
    model = learner.fit(VectorAssembler(inputCols=_INPUTS, outputCol="features").transform(learned))
    total = _sum_of(model)
    held = known.where("held").select("kind", "label", "weight", F.struct(*_INPUTS).alias("p"))
    scored = held.select("kind", "label", "weight", F.expr(f"round({total}, 2)").alias("score"))
    by_score = scored.groupBy("kind", "score").agg(F.sum("weight").alias("n"), F.expr("sum(weight * label)").alias("right"))
    thresholds: dict[str, float] = {}
    sums: dict[str, tuple[float, float]] = {}
    for row in by_score.orderBy(F.desc("score")).collect():  # a few hundred scores at most
        n, right = sums.get(row.kind, (0, 0))
        sums[row.kind] = n, right = n + row.n, right + row.right
        if right >= 0.95 * n and row.score > 0:
            thresholds[row.kind] = row.score
    thresholds |= {kind: 0.01 for kind in thresholds if sums[kind][1] >= 0.95 * sums[kind][0]}
    return total, thresholds


def _overlap(a: str, b: str) -> str:
    return f"{a}.start < {b}.stop and {b}.start < {a}.stop"


def found_spans(documents: DataFrame, model: tuple[str, dict[str, float]] | None) -> DataFrame:
    """The columns as they are, ``_rules`` (rule spans by kind) and ``_spans``: all spans,
    kind, start and stop, by kind, then start."""
    rows = documents.select("*", F.explode(F.array(rule_spans())).alias("_rules"))
    plain = "named_struct('kind', '{0}', 'start', r.start, 'stop', r.stop)"
    base = f"concat({', '.join(f'transform(_rules.{k}, r -> {plain.format(k)})' for k in RULES)})"
    if model is None or not model[1]:
        return rows.withColumn("_spans", F.expr(base))
    total, thresholds = model
    least = "case p.kind " + " ".join(f"when '{k}' then {v}D" for k, v in thresholds.items()) + " end"
    rows = rows.withColumn("_proposals", proposals())
    apart = f"not exists(base, r -> {_overlap('r', 'p')})"
    added = (
        f"transform(filter(_proposals, p -> {apart}), p -> named_struct('score', -round({total}, 2), "
        f"'start', p.start, 'stop', p.stop, 'kind', p.kind, 'enough', coalesce(round({total}, 2) >= {least}, false)))"
    )
    # The best first; of two that overlap the better stays, of equals the first.
    best = (
        f"aggregate(array_sort(filter({added}, a -> a.enough)), cast(array() as array<struct<kind: string, start: int, stop: int>>), "
        f"(out, a) -> if(exists(out, r -> {_overlap('r', 'a')}), out, "
        "concat(out, array(named_struct('kind', a.kind, 'start', a.start, 'stop', a.stop)))))"
    )
    order = "case s.kind " + " ".join(f"when '{k}' then {i}" for i, k in enumerate(KINDS)) + " end"
    every = _bound("base", base, f"if(size(_proposals) = 0, base, transform(array_sort(transform(concat(base, {best}), s -> "
        f"named_struct('rank', {order}, 'start', s.start, 'stop', s.stop, 'kind', s.kind))), "
        "s -> named_struct('kind', s.kind, 'start', s.start, 'stop', s.stop)))")
    return rows.withColumn("_spans", F.expr(every)).drop("_proposals")


def _listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.stop)), ',')")


def redacted(documents: DataFrame) -> DataFrame:
    """The documents with ``[kind]`` in place of every span, ``n_chars`` as it then is, if present.

    Spans of different rules may overlap; what they cover together goes, named
    after the first. A null text stays null, and texts without spans stay as they are.
    Every row is judged on its own.
    """
    rows = found_spans(documents.select(F.struct("*").alias("_row"), "doc_id", "text"), fitted(documents))
    rows = rows.select("_row", F.explode(F.array(F.col("_spans"))).alias("_spans"))
    ordered = "array_sort(transform(_spans, s -> named_struct('start', s.start, 'stop', s.stop, 'kind', s.kind)))"
    text = (
        f"aggregate({ordered}, named_struct('done', 0, 'out', cast(array() as array<string>)), (a, s) -> "
        "if(s.stop <= a.done, a, named_struct('done', s.stop, 'out', concat(a.out, "
        "if(s.start < a.done, cast(array() as array<string>), "
        "array(substr(_row.text, a.done + 1, s.start - a.done), concat('[', s.kind, ']')))))), "
        "a -> concat(array_join(a.out, ''), substr(_row.text, a.done + 1)))"
    )
    text = F.when(F.size("_spans") == 0, F.col("_row.text")).otherwise(F.expr(text))
    rows = rows.select("_row", F.explode(F.array(text)).alias("_text"))
    columns = {name: F.col(f"_row.{name}") for name in documents.columns}
    columns["text"] = F.col("_text")
    if "n_chars" in columns:
        columns["n_chars"] = F.when(
            F.expr("_text <=> _row.text"), F.col("_row.n_chars")
        ).otherwise(F.length("_text").cast(documents.schema["n_chars"].dataType))
    return rows.select(*(value.alias(name) for name, value in columns.items()))


def personal_data(documents: DataFrame) -> DataFrame:
    """Spans of personal data in each text, as code points, ends exclusive.

    ``doc_id``, the number of the rules' spans of each kind, ``base_sha256`` of
    these written ``kind:start:end``, and ``spans``: all spans, written alike. Null counts
    as empty. Repeated rows give equal rows; other columns are not looked at.
    """
    documents = documents.select("doc_id", "text")
    rows = found_spans(documents, fitted(documents)).drop("text")
    base = ", ".join(f"transform(_rules.{k}, s -> concat_ws(':', '{k}', s.start, s.stop))" for k in RULES)
    return rows.select(
        "doc_id",
        *(F.size(f"_rules.{kind}").cast("long").alias(f"n_{kind}") for kind in RULES),
        F.sha2(F.expr(f"array_join(concat({base}), ',')"), 256).alias("base_sha256"),
        _listed("_spans").alias("spans"),
    )


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))
