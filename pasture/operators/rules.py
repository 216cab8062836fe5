"""Declarative validation rules compiled to column expressions.

A dataset is described once (YAML, see ``pasture/mappings``): source → target
column names, and per target field its type, bounds, pattern, allowed values,
length limits and what a blank or absent value means.  ``validate`` compiles
that into ONE projection over the raw string frame producing the typed
columns, an ``errors`` array of structs and ``is_valid`` — no per-row Python,
no extra pass, so Catalyst keeps it inside one codegen stage.

Error types: ``missing``, ``type``, ``range``, ``pattern``, ``allowed_values``,
``length`` and the generic ``validation`` (a required value that is blank).
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from typing import Any

import yaml
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pasture.functions import coerce as C

ERROR_TYPE = T.StructType([
    T.StructField("field", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("error_type", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("constraint", T.StringType()),
])

MAPPING_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "mappings")


@dataclass
class FieldRule:
    name: str
    type: str = "str"                 # datetime | date | float | int | str | bool | time
    required: bool = False            # absent column → 'missing'
    min: float | None = None
    max: float | None = None
    pattern: str | None = None        # anchored at the start only (re.match)
    allowed: list | None = None
    min_length: int | None = None
    max_length: int | None = None
    on_blank: Any = "null"            # 'null' | 'type' | 'validation' | {'default': v}
    if_absent: Any = None             # default used when the column is absent
    store: str | None = None          # storage type (e.g. decimal(6,2)) at the load


@dataclass
class DatasetSpec:
    dataset: str
    columns: dict[str, str]
    fields: list[FieldRule]
    granularity: str = "daily"
    primary_key: list[str] = field(default_factory=list)
    strategy: str = "update"
    update_columns: list[str] | None = None
    target_table: str = ""
    device_from_file: bool = False
    partition_by: str | None = "month"

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    def rule(self, name: str) -> FieldRule:
        return next(f for f in self.fields if f.name == name)


def spec_from_dict(d: dict) -> DatasetSpec:
    fields = [FieldRule(name=k, **(v or {})) for k, v in d.get("fields", {}).items()]
    conflict = d.get("conflict", {}) or {}
    return DatasetSpec(
        dataset=d["dataset"], columns=dict(d.get("columns", {})), fields=fields,
        granularity=d.get("granularity", "daily"), primary_key=list(d.get("primary_key", [])),
        strategy=conflict.get("strategy", "update"), update_columns=conflict.get("update_columns"),
        target_table=d.get("target_table", d["dataset"]), device_from_file=d.get("device_from_file", False),
        partition_by=d.get("partition_by", "month"))


_REGISTRY: dict[str, DatasetSpec] = {}


def register_dataset(spec_or_yaml: DatasetSpec | str) -> DatasetSpec:
    """Add a dataset from a YAML text/path or a spec object."""
    if isinstance(spec_or_yaml, DatasetSpec):
        spec = spec_or_yaml
    else:
        text = spec_or_yaml
        if os.path.exists(text):
            with open(text, encoding="utf-8") as fh:
                text = fh.read()
        spec = spec_from_dict(yaml.safe_load(text))
    _REGISTRY[spec.dataset] = spec
    return spec


def get_spec(dataset: str) -> DatasetSpec:
    """Dataset → spec; unknown dataset is an error."""
    if not _REGISTRY:
        for fn in sorted(os.listdir(MAPPING_DIR)):
            if fn.endswith(".yaml"):
                register_dataset(os.path.join(MAPPING_DIR, fn))
    if dataset not in _REGISTRY:
        raise KeyError(f"unknown dataset {dataset!r}; known: {sorted(_REGISTRY)}")
    return _REGISTRY[dataset]


def list_datasets() -> list[str]:
    """Names of the registered datasets."""
    if not _REGISTRY:
        get_spec("energy_hourly")
    return sorted(_REGISTRY)


# ------------------------------------------------------------------ messages

def _err(rule: FieldRule, value: Column, etype: str, message: str, constraint: str | None) -> Column:
    return F.struct(F.lit(rule.name).alias("field"), value.cast("string").alias("value"),
                    F.lit(etype).alias("error_type"), F.lit(message).alias("message"),
                    F.lit(constraint).cast("string").alias("constraint"))


def _parse(rule: FieldRule, raw: Column) -> Column:
    t = rule.type
    if t == "datetime":
        return C.datetime_ampm(raw)
    if t == "date":
        return C.date_ampm(raw)
    if t == "float":
        return C.european_float(raw)
    if t == "int":
        return C.int_from_float(raw).try_cast("int")
    if t == "bool":
        return C.bool_text(raw)
    if t == "time":
        return C.time_text(raw)
    return C.strip(raw)


def _typed(rule: FieldRule, raw: Column | None, parsed: Column | None = None
           ) -> tuple[Column, Column, Column | None]:
    """(typed value, type-error predicate, blank predicate) for one field."""
    if raw is None:
        default = rule.if_absent
        return F.lit(default), F.lit(False), None
    parsed = _parse(rule, raw) if parsed is None else parsed
    blank = C.is_blank(raw) | (F.trim(raw) == "") if rule.type != "str" else C.is_blank(raw)
    bad = ~blank & parsed.isNull()
    value = parsed
    if isinstance(rule.on_blank, dict) and "default" in rule.on_blank:
        value = F.when(blank, F.lit(rule.on_blank["default"])).otherwise(parsed)
    if rule.type == "float":
        value = value.cast("double")
    return value, bad, blank


def _no_errors() -> Column:
    return F.array().cast(T.ArrayType(ERROR_TYPE))


def _fits(rule: FieldRule) -> bool:
    """Whether the rule's bounds alone keep its numbers within the storage type."""
    digits, scale = (int(x) for x in rule.store.removeprefix("decimal(").rstrip(")").split(","))
    most = 10 ** (digits - scale) - 1
    return rule.min is not None and rule.max is not None and -most <= rule.min and rule.max <= most


def field_errors(rule: FieldRule, raw: Column | None, value: Column, bad: Column,
                 blank: Column | None) -> Column:
    """The field's errors as an array of structs: every check that fails, in order.

    An array per field, concatenated by the caller, keeps the whole error
    computation in generated code — a higher-order ``filter`` over an array of
    nullable structs would run interpreted together with every check below it.
    """
    if raw is None:
        if rule.required:
            return F.array(_err(rule, F.lit(None), "missing", "Field required", None))
        return _no_errors()
    checks: list[tuple[Column, Column]] = []
    tname = {"datetime": "datetime", "date": "date", "float": "number", "int": "integer",
             "bool": "boolean", "time": "time"}.get(rule.type, "string")
    if blank is not None and rule.on_blank in ("type", "validation", "missing"):
        etype = rule.on_blank
        msg = {"type": f"Input should be a valid {tname}", "validation": "Input should not be empty",
               "missing": "Field required"}[etype]
        checks.append((blank, _err(rule, raw, etype, msg, None)))
    checks.append((bad, _err(rule, raw, "type", f"Input should be a valid {tname}", None)))
    num = value.try_cast("double")
    if rule.min is not None:
        below = (num < F.lit(float(rule.min))) | F.isnan(num)
        checks.append((below, _err(rule, raw, "range", f"Input should be greater than or equal to {rule.min}",
                                   json.dumps({"ge": rule.min}))))
    if rule.max is not None:
        above = num > F.lit(float(rule.max))         # a NaN is above every number
        if rule.min is not None:
            above = above & ~F.isnan(num)            # and has been reported by the other bound
        checks.append((above, _err(rule, raw, "range", f"Input should be less than or equal to {rule.max}",
                                   json.dumps({"le": rule.max}))))
    text = F.trim(raw)
    if rule.pattern is not None:
        checks.append((~text.rlike("^(?:" + rule.pattern + ")"),
                       _err(rule, raw, "pattern", f"Input should match pattern '{rule.pattern}'",
                            json.dumps({"pattern": rule.pattern}))))
    if rule.allowed is not None:
        checks.append((~value.cast("string").isin(*[str(a) for a in rule.allowed]),
                       _err(rule, raw, "allowed_values", f"Input should be one of {list(rule.allowed)}",
                            json.dumps({"allowed": rule.allowed}))))
    if rule.min_length is not None or rule.max_length is not None:
        ln = F.length(text)
        cond = F.lit(False)
        if rule.min_length is not None:
            cond = cond | (ln < rule.min_length)
        if rule.max_length is not None:
            cond = cond | (ln > rule.max_length)
        checks.append((cond, _err(rule, raw, "length",
                                  f"Length should be between {rule.min_length} and {rule.max_length}",
                                  json.dumps({"min_length": rule.min_length, "max_length": rule.max_length}))))
    if rule.store and not _fits(rule):      # a number its storage type cannot hold is an error, not a silent NULL
        scale = int(rule.store.split(",")[1].rstrip(")"))
        lost = value.isNotNull() & ~F.isnan(num) & (F.abs(num) < float("inf")) & F.round(value, scale).try_cast(rule.store).isNull()
        checks.append((lost, _err(rule, raw, "range", f"Input should fit {rule.store}", json.dumps({"store": rule.store}))))
    # a condition that cannot be told (a check of a value that did not parse) is no further error
    parts = [F.when(cond, F.array(err)).otherwise(_no_errors()) for cond, err in checks]
    return F.concat(*parts) if parts else _no_errors()


def _raw_col(df: DataFrame, spec: DatasetSpec, target: str) -> Column | None:
    for src, dst in spec.columns.items():
        if dst == target and src in df.columns:
            return F.col(f"`{src}`")
    return None


def validate(df: DataFrame, spec: DatasetSpec, keep: list[str] | tuple = (),
             stop_on_schema_errors: bool = False) -> DataFrame:
    """Typed columns + ``errors`` + ``is_valid`` + ``warnings``.

    Three projections: the first runs every field's parser once, the second
    derives value / blank / parse-failure flags, the third runs the checks.  Spark
    keeps the two apart instead of inlining the parsers into every check (it
    does not duplicate non-trivial expressions when collapsing projections),
    so each regex and timestamp parse runs once per row; the projections are
    still one codegen stage with no exchange.
    """
    parses: dict[str, Column] = {}
    flags: dict[str, Column] = {}
    raws: dict[str, str] = {}
    for rule in spec.fields:
        if _raw_col(df, spec, rule.name) is None:
            continue
        src = next(src for src, dst in spec.columns.items() if dst == rule.name and src in df.columns)
        raws[rule.name] = src
        parses[f"_p_{rule.name}"] = _parse(rule, F.col(f"`{src}`"))
        value, bad, blank = _typed(rule, F.col(f"`{src}`"), F.col(f"_p_{rule.name}"))
        flags.update({f"_v_{rule.name}": value, f"_x_{rule.name}": bad, f"_b_{rule.name}": blank})
    raw_cols = [c for c in sorted(set(raws.values())) if c not in keep]
    known = set(spec.columns) | {"file_id", "row_number", "source_file", "_file"}
    extra = [c for c in df.columns if c not in known and not c.startswith("_")]
    warnings = F.array(*[F.lit(f"Unexpected field: {c}") for c in extra]).cast("array<string>")
    # projection 1: each parser once; projection 2: value / failure / blank flags from the parsed columns
    zero = df.select(*[F.col(k) for k in keep], *[F.col(f"`{c}`") for c in raw_cols],
                     *[v.alias(k) for k, v in parses.items()])
    first = zero.select(*[F.col(k) for k in keep], *[F.col(f"`{c}`") for c in raw_cols],
                        *[v.alias(k) for k, v in flags.items()])
    typed: dict[str, Column] = {}
    schema_errs: list[Column] = []
    other_errs: list[Column] = []
    for rule in spec.fields:
        if rule.name not in raws:
            typed[rule.name] = F.lit(rule.if_absent)
            schema_errs.append(field_errors(rule, None, F.lit(None), F.lit(False), None))
            continue
        v, x, b = (F.col(f"_{t}_{rule.name}") for t in ("v", "x", "b"))
        typed[rule.name] = v
        other_errs.append(field_errors(rule, F.col(f"`{raws[rule.name]}`"), v, x, b))
    arr = lambda xs: F.concat(*xs) if xs else _no_errors()
    if stop_on_schema_errors and schema_errs:
        errors = F.when(F.size(arr(schema_errs)) > 0, arr(schema_errs)).otherwise(arr(other_errs))
    else:
        errors = arr(schema_errs + other_errs)
    out = first.select(*[F.col(k) for k in keep], *[c.alias(k) for k, c in typed.items()],
                       errors.alias("errors"), warnings.alias("warnings"))
    return out.withColumn("is_valid", F.size("errors") == 0)
