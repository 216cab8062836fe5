"""Personal data by candidate generation and gradient boosting.

Base kinds (email, ip, card, phone) are exact: a pattern and a check of its digits.  High-recall generators propose more
spans, which overlap the base ones and each other: long numbers with any separators, and long runs that mix letters and
digits.  Gradient-boosted trees score a proposal by its format (length, shares of digits, letters, hexadecimal digits,
separators) and context (quotes, assignment signs around it); a proposal is redacted if its score reaches its kind's
threshold, the lowest one with the wanted precision on calibration rows.

No hand-labelled spans exist, so the trees learn from the exact evidence at hand: a number is positive if a base span
covers it, a mixed run if a word like "token" or "password" is assigned to it.  The proposals of all documents are
gathered; the trees are fitted on a bounded sample of them (some ``SAMPLE``, an equal part of every kind and label), and
the thresholds are calibrated on all others.

The fitted trees become column expressions, so a document is searched, scored and redacted inside its own row: no
shuffle, no Python on the executors.  Offsets, overlaps and redacted texts come from running sums and maxima over the
spans in order, worked out in blocks, so a log of tens of thousands of addresses in one text costs no more per span.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pasture.llm.scratch import stored

#: Base patterns.  Possessive and look-behind forms match what the plain ones do, but neither nest calls as deep as a
#: text is long nor try every start inside one run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PROPOSED = {
    "number": r"(?<![0-9])[0-9](?:[ .()-]{0,2}[0-9]){8,}+",
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{16,}+",
}
KINDS = (*BASE, *PROPOSED)
#: What a text must hold before a pattern is run over it.
_GUARD = {
    "email": "instr(t, '@') > 0",
    "ip": r"rlike(t, '[0-9]\\.[0-9]+\\.[0-9]+\\.[0-9]')",
    "card": "rlike(t, '[0-9](?:[ -]?[0-9]){12}')",
    "phone": "instr(t, '+') > 0",
    "number": r"rlike(t, '[0-9](?:[ .()-]{0,2}[0-9]){8}')",
    "secret": "rlike(t, '[A-Za-z0-9_/+-]{16}')",
}
_KEYED = r"(?i)(?:token|secret|password|passwd|api.?key|access.?key|auth|credential)[^A-Za-z0-9]{1,6}$"
_SPAN = "struct<s:int,e:int,v:string,b:string,a:string>"
_CHECK = {
    "email": "true",
    "ip": "forall(split(x.v, '[.]'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', right(ltrim('0', p), 3)) as int) <= 255)",
    "card": """length(translate(x.v, ' -', '')) between 13 and 19 and aggregate(
        split(reverse(translate(x.v, ' -', '')), ''), named_struct('n', 0, 'k', 0),
        (acc, c) -> if(c = '', acc, named_struct('n', acc.n + case when acc.k = 0 then cast(c as int)
            when cast(c as int) > 4 then 2 * cast(c as int) - 9 else 2 * cast(c as int) end, 'k', 1 - acc.k)),
        acc -> acc.n % 10 = 0)""",
    "phone": "length(regexp_replace(x.v, '[^0-9]', '')) between 9 and 15",
}
FEATURES = ("length", "digits", "letters", "hex", "upper", "apart", "distinct", "quoted", "assigned", "joined", "plus", "number")

SAMPLE, RATES = 20_000, 1_000_000
BLOCK, PIECE = 256, 1024        # spans, and characters of a text, that are worked on at once
PRECISION, SUPPORT = 0.95, 20


@dataclass
class Model:
    """Fitted trees as (weight, nested (feature, threshold, left, right) or leaf value), and a threshold per kind."""

    trees: list[tuple[float, object]] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _once(c: Column) -> Column:
    """``c`` in a projection that filters stay above: pushed down, they would work out every span several times over."""
    return F.when(F.monotonically_increasing_id() >= 0, c)


def _running(d: DataFrame, names: dict[str, str], step: str, start: int) -> DataFrame:
    """Adds an array column for every array column of integers named: what stands before each element, combined by
    ``step`` (associative, over a and b) from ``start``."""
    empty = f"named_struct('at', {start}, 'out', cast(array() as array<int>))"
    grown = f"named_struct('at', {step}, 'out', concat(acc.out, array(acc.at)))"

    def at(x: str) -> str:
        return grown.replace("$a", "acc.at").replace("$b", x)

    d = d.withColumns({f"b_{n}": F.expr(f"""transform(sequence(0, (size({v}) - 1) div {BLOCK}), i -> aggregate(
        slice({v}, i * {BLOCK} + 1, {BLOCK}), {empty}, (acc, x) -> {at('x')}))""") for n, v in names.items()})
    d = d.withColumns({f"o_{n}": F.expr(f"aggregate(b_{n}, {empty}, (acc, x) -> {at('x.at')}, acc -> acc.out)") for n in names})
    return d.withColumns({n: F.expr(f"""flatten(transform(arrays_zip(b_{n}, o_{n}), y -> transform(y.b_{n}.out, z -> {
        step.replace('$a', f'y.o_{n}').replace('$b', 'z')})))""") for n in names}).drop(*(f"{x}_{n}" for n in names for x in "bo"))


def _search(d: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Adds an array column of spans per pattern: offsets in code points (end exclusive), the text found, and what
    stands before and after it.  The texts between the matches give the offsets."""
    d = d.withColumns({f"m_{k}": F.expr(f"if({_GUARD[k]}, regexp_extract_all(t, '{_sql(p)}', 0), array())") for k, p in patterns.items()})
    d = d.withColumns({f"p_{k}": F.expr(f"if(size(m_{k}) > 0, split(t, '{_sql(p)}', -1), array())") for k, p in patterns.items()})
    d = d.withColumns({f"l_{k}": F.expr(f"transform(m_{k}, (x, i) -> length(p_{k}[i]) + length(x))") for k in patterns})
    d = _running(d, {f"at_{k}": f"l_{k}" for k in patterns}, "$a + $b", 0)
    return d.withColumns({k: F.expr(f"""cast(transform(m_{k}, (x, i) -> named_struct(
        's', at_{k}[i] + length(p_{k}[i]), 'e', at_{k}[i] + l_{k}[i], 'v', x,
        'b', right(p_{k}[i], 32), 'a', left(p_{k}[i + 1], 1))) as array<{_SPAN}>)""") for k in patterns}).drop(
            *(f"{x}_{k}" for k in patterns for x in ("m", "p", "l", "at")))


def _share(kept: str) -> str:
    return f"(length(x.v) - length(regexp_replace(x.v, '[{kept}]', ''))) / cast(length(x.v) as double)"


_FEATURE_SQL = {
    "length": "cast(length(x.v) as double)",
    "digits": _share("0-9"), "letters": _share("A-Za-z"), "hex": _share("0-9a-fA-F"), "upper": _share("A-Z"),
    "apart": "cast(length(regexp_replace(x.v, '[A-Za-z0-9]', '')) as double)",
    "distinct": "size(array_distinct(split(x.v, ''))) / cast(length(x.v) as double)",
    "quoted": "if(right(x.b, 1) in ('\"', '\\'') and x.a in ('\"', '\\''), 1D, 0D)",
    "assigned": "if(rlike(x.b, '[=:]\\\\s*[\"\\']?$'), 1D, 0D)",
    "joined": "if(rlike(x.b, '[A-Za-z0-9.,@]$') or rlike(x.a, '[A-Za-z0-9@]'), 1D, 0D)",
    "plus": "if(rlike(x.b, '[+]$'), 1D, 0D)",
}


def _proposals(docs: DataFrame, carried) -> DataFrame:
    """(row, t, base, proposed): the carried columns as a struct, the text, its base spans and its scored-to-be proposals."""
    d = docs.select(F.struct(*carried).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    d = _search(d, BASE | PROPOSED)
    base = [F.expr(f"transform(filter({k}, x -> {check}), x -> named_struct('kind', '{k}', 's', x.s, 'e', x.e))")
            for k, check in _CHECK.items()]
    d = d.withColumn("base", F.concat(*base))
    # a proposal at its end, a base span at its start: base spans before a proposal overlap it if one ends behind its start
    events = [f"transform({k}, x -> named_struct('at', x.e, 'what', {n}, 'top', -1, 'x', x))" for n, k in enumerate(PROPOSED)]
    events.append(f"transform(base, y -> named_struct('at', y.s, 'what', {len(PROPOSED)}, 'top', y.e, 'x', cast(null as {_SPAN})))")
    d = d.withColumn("events", F.expr(f"array_sort(concat({', '.join(events)}))"))
    d = _running(d.withColumn("tops", F.expr("transform(events, v -> v.top)")), {"reach": "tops"}, "greatest($a, $b)", -1)
    d = d.withColumn("met", F.expr("arrays_zip(events, reach)"))
    parts = []
    for n, k in enumerate(PROPOSED):
        label = "w.reach > x.s" if k == "number" else f"rlike(x.b, '{_sql(_KEYED)}')"
        feats = ", ".join(f"'{name}', {sql}" for name, sql in _FEATURE_SQL.items())
        made = (f"named_struct('kind', '{k}', 's', x.s, 'e', x.e, 'covered', w.reach > x.s, "
                f"'label', if({label}, 1D, 0D), {feats}, 'number', {1 if k == 'number' else 0}D)")
        parts.append(F.expr(f"transform(filter(met, w -> w.events.what = {n}), w -> {made.replace('x.', 'w.events.x.')})"))
    return d.select("row", "t", "base", _once(F.concat(*parts)).alias("proposed"))


def _tree(node):
    """A JVM decision tree as nested tuples."""
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    return (int(node.split().featureIndex()), float(node.split().threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def _value(tree, x: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, at, left, right = tree
    return F.when(x[FEATURES[feature]] <= at, _value(left, x)).otherwise(_value(right, x))


def score(model: Model, x: Column) -> Column:
    """Probability of the boosted trees for a struct of features; zero for an unfitted model."""
    if not model.trees:
        return F.lit(0.0)
    margin = sum((F.lit(w) * _value(t, x) for w, t in model.trees), F.lit(0.0))
    return 1 / (1 + F.exp(-2 * margin))


def fit(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION, support: int = SUPPORT) -> Model:
    """Trees from about ``sample`` proposals at most, thresholds from the other proposals of all documents.

    Without both positive and negative proposals nothing is fitted, and only base spans are found.
    """
    return _fit(stored(_proposals(docs, ["doc_id"]).drop("t"), "proposals"), sample, precision, support)


def _fit(d: DataFrame, sample: int = SAMPLE, precision: float = PRECISION, support: int = SUPPORT) -> Model:
    """The model of a stored table of proposals (row with doc_id, proposed)."""
    rows = d.select(F.col("row.doc_id").alias("doc_id"), F.explode("proposed").alias("x")).select("doc_id", "x.*")
    rows = rows.withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), "kind", "s", "e"))
    found = {(r["kind"], r["label"]): r["n"] for r in rows.groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len({label for _, label in found}) < 2:
        return Model()
    # at most seven tenths of a kind and label, and no more than its part of the sample
    part = F.lit(False)
    for (k, label), n in found.items():
        rate = min(RATES, int(RATES * sample / (0.7 * len(found) * n)))
        part = part | ((F.col("kind") == k) & (F.col("label") == label) & (F.pmod(F.shiftright("h", 20), F.lit(RATES)) < rate))
    part = part & (F.pmod("h", F.lit(10)) < 7)
    train = stored(rows.where(part).orderBy("h", "doc_id", "kind", "s").limit(2 * sample), "trained")
    seen = train.agg(F.min("label"), F.max("label")).first()
    if seen[0] is None or seen[0] == seen[1]:
        return Model()
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(train.coalesce(1))
    gbt = GBTClassifier(maxIter=12, maxDepth=3, stepSize=0.3, seed=42, cacheNodeIds=False).fit(vectors)
    model = Model([(float(w), _tree(t._java_obj.rootNode())) for w, t in zip(gbt.treeWeights, gbt.trees)])
    scored = rows.where(~part).select("kind", "label", F.floor(100 * score(model, F.struct(*FEATURES))).alias("step"))
    scored = scored.groupBy("kind", "label", "step").agg(F.count(F.lit(1)).alias("n")).collect()
    left: dict[tuple, int] = {}
    for r in scored:
        left[r["kind"], r["label"]] = left.get((r["kind"], r["label"]), 0) + r["n"]
    for k in PROPOSED:
        model.thresholds[k] = math.inf
        yes, weighed = 0, {0.0: 0.0, 1.0: 0.0}
        steps: dict[int, list] = {}
        for r in scored:
            if r["kind"] == k:
                steps.setdefault(r["step"], []).append(r)
        for step in sorted(steps, reverse=True):
            for r in steps[step]:
                yes += r["n"] if r["label"] else 0
                # the rows left stand for all of their label: the sample takes more of the rarer one
                weighed[r["label"]] += r["n"] * found[k, r["label"]] / left[k, r["label"]]
            if yes >= support and weighed[1.0] >= precision * sum(weighed.values()):
                model.thresholds[k] = step / 100
    return model


def _selected(d: DataFrame, model: Model) -> DataFrame:
    """``spans`` in place of ``proposed``: all spans in order of kind and start; added ones keep clear of the base."""
    def taken(x: Column) -> Column:
        enough = F.lit(False)
        for k, least in model.thresholds.items():
            if math.isfinite(least):
                enough = enough | ((x["kind"] == F.lit(k)) & (F.floor(100 * score(model, x)) >= round(100 * least)))
        return enough & ~x["covered"]

    added = F.transform(F.filter("proposed", taken), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    return d.withColumn("spans", F.concat("base", added)).drop("proposed")


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) per row of ``docs`` (doc_id, text).

    Counts are of base spans; ``spans`` lists kind:start:end by kind, then start.  Null texts count as empty: no spans
    and the digest of the empty string.  Repeated rows each return a row.
    """
    d = _proposals(docs, ["doc_id"]).drop("t")
    if model is None:               # what is found in the texts serves both to learn and to choose
        d = stored(d, "found")
        model = _fit(d)
    d = _selected(d, model)
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint) as n_{k}") for k in BASE]
    return d.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), *counts, F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"),
                    _listed("spans").alias("spans"), (F.size("spans") - F.size("base")).cast("bigint").alias("n_added"))


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets, and ``n_chars`` (if there) counted anew.

    Overlapping spans leave the tag of the one that starts first.  Rows without spans, null texts included, stay as
    they are.
    """
    model = model or fit(docs)
    d = _selected(_proposals(docs, ["*"]), model)
    d = d.withColumn("cuts", F.expr("array_sort(transform(spans, x -> named_struct('s', x.s, 'e', x.e, 'kind', x.kind)))"))
    d = d.withColumn("ends", F.expr("transform(cuts, x -> x.e)"))
    d = _running(d, {"past": "ends"}, "greatest($a, $b)", 0)
    d = d.withColumn("pieces", F.expr(f"if(size(cuts) > 0, regexp_extract_all(t, '(?s).{{1,{PIECE}}}+', 0), array())"))

    def between(a: str, z: str) -> str:
        first, last = f"({a}) div {PIECE}", f"({z}) div {PIECE}"
        held = f"if({first} = {last}, pieces[cast({first} as int)], array_join(slice(pieces, cast({first} as int) + 1, cast({last} - {first} as int) + 1), ''))"
        return f"if({a} = {z}, '', substring({held}, ({a}) % {PIECE} + 1, {z} - {a}))"

    d = d.withColumns({"kept": F.expr(f"""transform(arrays_zip(cuts, past), w -> if(w.cuts.s < w.past, '',
        concat({between('w.past', 'w.cuts.s')}, '[', upper(w.cuts.kind), ']')))"""), "last": F.expr("coalesce(array_max(ends), 0)")})
    clean = F.expr(f"concat(array_join(kept, ''), {between('last', 'length(t)')})")
    d = d.withColumn("clean", _once(F.when(F.size("cuts") > 0, clean).otherwise(F.col("row.text"))))
    return d.select(*(F.col("clean").alias(c) if c == "text" else
                      F.when(F.size("cuts") > 0, F.length("clean").cast(t)).otherwise(F.col(f"row.{c}")).alias(c) if c == "n_chars"
                      else F.col(f"row.`{c}`").alias(c) for c, t in docs.dtypes))
