"""Quality checks.

Constraint documents compile into one boolean column per (column, rule);
violations are exploded into a table ``(table, row_ord, column, rule)``.
Validation runs on the *file view* of a table (arrays as JSON text, times as
ISO-8601 text), i.e. on what the CSV sink writes.

``coercion="typed"`` (default) checks typed columns.  ``coercion="suffix"``
reproduces the original reader: every cell is text, ``""`` is null, ``true``/
``false`` become booleans on every column, only ``*_score`` parses as integer
and ``*_weight``/``*price`` as float — so, for instance, the temperature and
confidence columns of the claims table always fail their ``number`` type.  The
coerced cells are VARIANT columns, whose type, text and number are read once, as
columns that the rules then refer to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.jsontext import json_list_text
from ..schemas import FLOAT_SUFFIXES, INT_SUFFIXES
from .pages import py_isoformat_z
from .sequence import top_rows_per_group

RULE_ORDER = ("type", "enum", "pattern", "minLength", "maxLength", "minimum", "maximum")
SAMPLE_ERRORS = 5


def file_view(df: DataFrame, keep=()) -> DataFrame:
    """Arrays -> ``json.dumps`` text, timestamps -> ``isoformat()+'Z'``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in keep:
            cols.append(c)
        elif isinstance(f.dataType, T.ArrayType):
            cols.append(json_list_text(c).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(py_isoformat_z(c).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def _py_str(c: Column, dtype) -> Column:
    """Text of a typed cell as the CSV writer prints it (``str(value)``)."""
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "true").when(~c, "false")
    return c.cast("string")


class _Cell:
    """kind / text / number / boolean views of one typed column.  ``prepare``
    projects them once as columns so the rules reference plain attributes
    (keeps the expression trees small for wide tables)."""

    def __init__(self, name: str, dtype):
        c = F.col(name)
        self.name = name
        num = boolean = None
        text = c.cast("string")
        if isinstance(dtype, T.StringType):
            kind = F.when(c.isNull(), "null").otherwise("string")
        elif isinstance(dtype, T.BooleanType):
            kind, boolean = F.when(c.isNull(), "null").otherwise("boolean"), c
        elif isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            kind, num = F.when(c.isNull(), "null").otherwise("integer"), c.cast("double")
        elif isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
            d = c.cast("double")
            kind, num = F.when(c.isNull(), "null").when(d == F.floor(d), "integral_number").otherwise("number"), d
        else:
            kind = F.when(c.isNull(), "null").otherwise("other")
        self._exprs = {"k": kind, "t": text, "n": num, "b": boolean}
        self.kind = F.col(f"_k_{name}")
        self.text = F.col(f"_t_{name}")
        self.num = F.col(f"_n_{name}") if num is not None else None
        self.bool = F.col(f"_b_{name}") if boolean is not None else None

    def prepare(self):
        return [e.alias(f"_{k}_{self.name}") for k, e in self._exprs.items() if e is not None]


class _VariantCell:
    """The same views of a coerced cell, as far as its constraints need them.
    Each of ``steps`` adds columns that refer to those of the step before: the
    cell's text, its VARIANT, that one's type and values, and the kind."""

    def __init__(self, name: str, dtype, spec: dict):
        c, t, v, of, number = (F.col(n) for n in (name, f"_t_{name}", f"_v_{name}", f"_o_{name}", f"_n_{name}"))
        rule, view = _name_rule(name), {"o": F.schema_of_variant(v)}
        kind = F.when(v.isNull(), "null").when(of == "BOOLEAN", "boolean")
        self.num = self.bool = None
        if rule != "text":
            self.num = number
            view["n"] = F.try_variant_get(F.when(F.schema_of_variant(v).isin("BIGINT", "DOUBLE"), v), "$", "double")
            kind = kind.when(of == "BIGINT", "integer").when((of == "DOUBLE") & (number == F.floor(number)), "integral_number") \
                       .when(of == "DOUBLE", "number")
        if any(isinstance(x, bool) for x in spec.get("enum", ())):
            self.bool = F.col(f"_b_{name}")
            view["b"] = F.try_variant_get(F.when(F.schema_of_variant(v) == "BOOLEAN", v), "$", "boolean")
        if spec.keys() & {"enum", "pattern", "minLength", "maxLength"}:
            view["s"] = F.try_variant_get(v, "$", "string")
        self.kind, self.text = F.col(f"_k_{name}"), F.col(f"_s_{name}")
        text = _py_str(c, dtype)
        self.steps = ({"t": F.when(text != "", text)}, {"v": _coerced(t, rule)}, view, {"k": kind.otherwise("string")})


def _coerced(text: Column, rule: str) -> Column:
    """VARIANT of a text cell, by the original's rule for its name (Q01-Q03)."""
    out = F.when(text.isin("true", "false"), text.try_cast("boolean").cast("variant"))
    if rule == "int":
        out = out.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$") & text.try_cast("long").isNotNull(), text.try_cast("long").cast("variant"))
    elif rule == "float":
        out = out.when(text.try_cast("double").isNotNull(), text.try_cast("double").cast("variant"))
    return out.otherwise(text.cast("variant"))


def _name_rule(name: str) -> str:
    return "int" if name.endswith(INT_SUFFIXES) else "float" if name.endswith(FLOAT_SUFFIXES) else "text"


def _type_ok(cell: _Cell, types) -> Column:
    allowed = set(types if isinstance(types, list) else [types])
    kinds = set()
    if "null" in allowed:
        kinds.add("null")
    if "string" in allowed:
        kinds.add("string")
    if "boolean" in allowed:
        kinds.add("boolean")
    if "number" in allowed:
        kinds |= {"number", "integer", "integral_number"}
    if "integer" in allowed:
        kinds |= {"integer", "integral_number"}
    return cell.kind.isin(*sorted(kinds)) if kinds else F.lit(False)


def _enum_ok(cell: _Cell, values) -> Column:
    strs = [v for v in values if isinstance(v, str)]
    nums = [float(v) for v in values if isinstance(v, (int, float)) and not isinstance(v, bool)]
    bools = [v for v in values if isinstance(v, bool)]
    ok = F.lit(False)
    if strs:
        ok = ok | ((cell.kind == "string") & cell.text.isin(*strs))
    if nums and cell.num is not None:
        ok = ok | (cell.kind.isin("integer", "integral_number", "number") & cell.num.isin(*nums))
    if bools and cell.bool is not None:
        ok = ok | ((cell.kind == "boolean") & cell.bool.isin(*bools))
    return F.coalesce(ok, F.lit(False))


def _rules(schema_doc: dict, cells: dict) -> list[tuple[str, str, Column]]:
    """``[(column, rule, ok_column)]`` in declaration order: missing required
    columns first, then every property's keywords in ``RULE_ORDER``."""
    out = [(name, "required", F.lit(False)) for name in schema_doc.get("required", []) if name not in cells]
    for name, spec in schema_doc.get("properties", {}).items():
        if name not in cells:
            continue
        cell = cells[name]
        is_str = cell.kind == "string"
        is_num = cell.kind.isin("integer", "integral_number", "number") if cell.num is not None else F.lit(False)
        for rule in RULE_ORDER:
            if rule not in spec:
                continue
            arg = spec[rule]
            if rule == "type":
                ok = _type_ok(cell, arg)
            elif rule == "enum":
                ok = _enum_ok(cell, arg)
            elif rule == "pattern":
                ok = ~is_str | F.coalesce(cell.text.rlike("(?U)" + arg), F.lit(False))
            elif rule == "minLength":
                ok = ~is_str | (F.length(cell.text) >= arg)
            elif rule == "maxLength":
                ok = ~is_str | (F.length(cell.text) <= arg)
            elif rule == "minimum":
                ok = ~is_num | (cell.num >= float(arg)) if cell.num is not None else F.lit(True)
            else:
                ok = ~is_num | (cell.num <= float(arg)) if cell.num is not None else F.lit(True)
            out.append((name, rule, F.coalesce(ok, F.lit(False))))
    return out


def _failed(rules) -> Column:
    return F.array_compact(F.array(*[
        F.when(~ok, F.struct(F.lit(col).alias("column"), F.lit(rule).alias("rule"))) for col, rule, ok in rules]))


def failed_rules(df: DataFrame, schema_doc: dict, row_col: str = "row_ord", coercion: str = "typed"):
    """``(view, failed)``: the file view (plus prepared cell columns) and an
    array column of the failed ``(column, rule)`` structs of each row."""
    view = file_view(df, keep=(row_col,))
    dtypes = {f.name: f.dataType for f in view.schema.fields}
    names = [n for n in schema_doc.get("properties", {}) if n in dtypes]
    present = {n: None for n in schema_doc.get("required", []) if n in dtypes}
    if coercion == "suffix":
        cells = {n: _VariantCell(n, dtypes[n], schema_doc["properties"][n]) for n in names}
        for step in zip(*(cell.steps for cell in cells.values())):
            view = view.select("*", *[e.alias(f"_{k}_{n}") for n, of in zip(names, step) for k, e in of.items()])
        return view, _failed(_rules(schema_doc, present | cells))
    cells = {n: _Cell(n, dtypes[n]) for n in names}
    return view.select("*", *[c for cell in cells.values() for c in cell.prepare()]), _failed(_rules(schema_doc, present | cells))


def violations(df: DataFrame, schema_doc: dict, table: str, row_col: str = "row_ord",
               coercion: str = "typed") -> DataFrame:
    """Q04: every failed (column, rule) of every row: ``(table, row_ord,
    column, rule, rule_pos)``; ``rule_pos`` orders a row's failures (0 = the
    one reported when a single error per row is wanted)."""
    view, failed = failed_rules(df, schema_doc, row_col, coercion)
    # The outer form: a plain explode makes the optimizer push "has failures" down
    # through the table's whole derivation, where it repeats the expressions.
    return (view.select(F.col(row_col).alias("row_ord"), failed.alias("_v"))
                .select(F.lit(table).alias("table"), "row_ord", F.posexplode_outer("_v").alias("rule_pos", "_f")).where("_f is not null")
                .select("table", "row_ord", F.col("_f.column").alias("column"), F.col("_f.rule").alias("rule"),
                        "rule_pos"))


def check_errors(df: DataFrame, flags, row_col: str = "row_ord") -> DataFrame:
    """Several row checks in one pass: ``flags`` = ``[(check_ord, bool
    column)]`` -> one ``(check_ord, row_ord)`` error row per raised flag."""
    raised = F.array_compact(F.array(*[F.when(F.coalesce(f, F.lit(False)), F.lit(i)) for i, f in flags]))
    return df.select(F.col(row_col).alias("row_ord"), F.explode(raised).alias("check_ord")) \
             .select("check_ord", "row_ord")


def row_errors(viol: DataFrame) -> DataFrame:
    """One error per failing row (the first failure in declaration order)."""
    return viol.where(F.col("rule_pos") == 0).drop("rule_pos")


def temperature_check(claims: DataFrame, row_col: str = "row_ord",
                      temp_col: str = "extraction_temperature") -> DataFrame:
    """Q05: rows whose temperature is not 0 (a missing value is an error too)."""
    t = F.col(temp_col).cast("double")
    return claims.where(t.isNull() | (t != 0)).select(F.col(row_col).alias("row_ord"), t.alias(temp_col))


def required_fields(df: DataFrame, fields, row_col: str = "row_ord") -> DataFrame:
    """Q06: one error per (row, empty or missing required field)."""
    present = [f for f in fields if f in df.columns]
    missing = [f for f in fields if f not in df.columns]
    base = df.select(F.col(row_col).alias("row_ord"), *[F.col(f).cast("string").alias(f) for f in present])
    if present:
        long = base.unpivot("row_ord", present, "field", "value")
        out = long.where(F.col("value").isNull() | (F.col("value") == "")).select("row_ord", "field")
    else:
        out = base.select("row_ord", F.lit(None).cast("string").alias("field")).where(F.lit(False))
    for f in missing:
        out = out.unionByName(base.select("row_ord", F.lit(f).alias("field")))
    return out


def summary(spark, checks, errors: DataFrame | None = None) -> DataFrame:
    """Q07: ``(check_ord, check, passed, n_errors, first_rows)``.

    ``checks`` is ``[(name, errors_df_with_row_ord or None)]``; errors of the
    checks given as ``None`` come pre-labelled in ``errors`` (``check_ord``,
    ``row_ord``, see ``check_errors``).  One aggregation over the union of the
    error rows plus a partial top-5 per check."""
    names = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(checks)], "check_ord int, check string")
    errs = errors.select(F.col("check_ord").cast("int"), F.col("row_ord").cast("long")) if errors is not None \
        else None
    for i, (_, e) in enumerate(checks):
        if e is None:
            continue
        part = e.select(F.lit(i).alias("check_ord"), F.col("row_ord").cast("long").alias("row_ord"))
        errs = part if errs is None else errs.unionByName(part)
    counts = errs.groupBy("check_ord").agg(F.count(F.lit(1)).alias("n_errors"))
    first = top_rows_per_group(errs, ["check_ord"], [F.col("row_ord")], SAMPLE_ERRORS)
    sample = first.groupBy("check_ord").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("row_ord")), lambda x: x.cast("string")), ",")
         .alias("first_rows"))
    out = names.join(counts, "check_ord", "left").join(sample, "check_ord", "left")
    n = F.coalesce(F.col("n_errors"), F.lit(0)).cast("long")
    return out.select("check_ord", "check", (n == 0).alias("passed"), n.alias("n_errors"),
                      F.coalesce(F.col("first_rows"), F.lit("")).alias("first_rows"))


def min_score_check(products: DataFrame, min_score: int, cohort: str = "T") -> DataFrame:
    """D13 (extension): targeted products whose max exaggeration score stays
    below the node's ``min_l_score``."""
    return products.where(F.col("sampling_cohort") == cohort).select(
        "asin", "l_max_token_score", (F.coalesce(F.col("l_max_token_score"), F.lit(0)) < min_score)
        .alias("below_min"))


def row_numbers(df: DataFrame, order_col: str, name: str = "row_ord") -> DataFrame:
    """Q08: 1-based file row numbers from an order column (exact, distributed)."""
    from .sequence import ordinal
    return ordinal(df, order_col, name=name).withColumn(name, F.col(name) + 1)


__all__ = ["file_view", "failed_rules", "violations", "check_errors", "row_errors", "temperature_check", "required_fields",
           "summary", "min_score_check", "row_numbers"]
