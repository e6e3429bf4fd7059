"""Running extractors over work items."""

import re
from collections.abc import Iterable, Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracemill.operators.classify import work_items
from tracemill.operators.distribute import spread
from tracemill.operators.pyextract import run_python
from tracemill.operators.registry import Emit, Extractor
from tracemill.schemas import ATTRIBUTES, EXTRACTION_ERROR, RESULTS, TIMES

PYTHON_COLUMNS = ("parser", "path", "name", "length", "mtime", "content")


def _quote(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


_CAST = re.compile(r"""(?i)'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|(?<![\w.])CAST\s*\(""", re.S)


def lenient(sql: str | None) -> str | None:
    """Casts as `TRY_CAST`: a value that can't be converted is null and doesn't end the job."""
    return sql and _CAST.sub(lambda m: m[0] if m[0][0] in "'\"`" else "TRY_CAST(", sql)


def guarded(value: Column) -> Column:
    """A struct with `value`, or null where computing it raises, whatever the expression.

    To be used in a branch of a conditional only: what stands there isn't
    computed ahead of it when two expressions have a part in common.
    """
    jvm = SparkSession.active()._jvm
    as_column = jvm.org.apache.spark.sql.classic.ExpressionUtils
    inner = as_column.expression(F.struct(value.alias("value"))._jc)
    return Column(as_column.column(jvm.org.apache.spark.sql.catalyst.expressions.TryEval(inner)))


def bind_settings(extractors: Iterable[Extractor], values: Mapping[str, object]) -> tuple[Extractor, ...]:
    """Extractors with each `:name` in their expressions replaced by that setting as a literal."""

    def bound(sql: str | None) -> str | None:
        def literal(match: re.Match) -> str:
            value = values.get(match[1])
            return str(value) if isinstance(value, int) else _quote(value)

        return sql and re.sub(r"(?<!:):(preferred_\w+)", literal, sql)

    def bound_emit(emit: Emit) -> Emit:
        return replace(
            emit,
            when=bound(emit.when),
            attributes={k: bound(v) for k, v in emit.attributes.items()},
            times={k: bound(v) for k, v in emit.times.items()},
            attribute_map=bound(emit.attribute_map),
        )

    return tuple(replace(e, records=bound(e.records), emits=tuple(map(bound_emit, e.emits))) for e in extractors)


def _rules(extractors: list[Extractor]) -> list[tuple[int, Extractor, Emit]]:
    """All emit rules, numbered."""
    pairs = [(e, emit) for e in extractors for emit in e.emits]
    return [(n, e, emit) for n, (e, emit) in enumerate(pairs)]


def _by_rule(rules: list[tuple[int, Extractor, Emit]], value, kind: str) -> Column:
    """A result column: the value of the rule that made the row."""
    cases = " ".join(f"WHEN {n} THEN {sql}" for n, e, emit in rules if (sql := value(e, emit)) is not None)
    return F.expr(f"CAST(CASE rule {cases} END AS {kind})" if cases else f"CAST(NULL AS {kind})")


def _attributes(_: Extractor, emit: Emit) -> str:
    if emit.attribute_map:
        return f"coalesce(CAST({lenient(emit.attribute_map)} AS {ATTRIBUTES}), CAST(map() AS {ATTRIBUTES}))"
    pairs = ", ".join(f"{_quote(k)}, {lenient(v)}" for k, v in emit.attributes.items())
    return f"CAST(map({pairs}) AS {ATTRIBUTES})"


def _times(_: Extractor, emit: Emit) -> str:
    pairs = ", ".join(
        f"named_struct('timestamp_desc', {_quote(k)}, 'timestamp', {lenient(v)})" for k, v in emit.times.items()
    )
    return f"CAST(array({pairs}) AS {TIMES})"


def _records(extractors: list[Extractor]) -> Column:
    """The records each item's extractor cuts its content into, as a struct's `value`; one empty record otherwise.

    Null where a guarded extractor's cut raises.
    """
    whole = F.struct(F.array(F.lit(None).cast("string")).alias("value"))
    cut = None
    for e in extractors:
        if e.records:
            value = F.coalesce(F.expr(lenient(e.records)), F.array().cast("array<string>"))
            case = (F.col("parser") == e.name, guarded(value) if e.guarded else F.struct(value.alias("value")))
            cut = F.when(*case) if cut is None else cut.when(*case)
    return whole if cut is None else cut.otherwise(whole)


def _fired(extractors: list[Extractor], cut_failed: Column) -> Column:
    """Numbers of the rules that give a row for this record, by the item's extractor.

    Rules are numbered through; behind them comes, for each, the row that says
    its condition raised, and for each extractor the row that says its cut did.
    A name nobody has gives null and so no rows.
    """
    rules = _rules(extractors)
    fired = None
    for k, e in enumerate(extractors):
        mine = []
        for n, owner, emit in rules:
            if owner is not e:
                continue
            if emit.when is None:
                mine.append(F.array(F.lit(n)))
                continue
            holds = F.expr(f"CASE WHEN {lenient(emit.when)} THEN array({n}) ELSE CAST(array() AS ARRAY<INT>) END")
            mine.append(F.coalesce(guarded(holds)["value"], F.array(F.lit(len(rules) + n))) if e.guarded else holds)
        value = F.concat(*mine)
        if e.guarded and e.records:
            value = F.when(cut_failed, F.array(F.lit(2 * len(rules) + k))).otherwise(value)
        case = (F.col("parser") == e.name, value)
        fired = F.when(*case) if fired is None else fired.when(*case)
    return fired


def _guarded_values(extractors: list[Extractor]) -> Column | None:
    """Attributes and times of the rules of guarded extractors, null where one of them raises."""
    values = None
    for n, e, emit in _rules(extractors):
        if e.guarded:
            both = F.struct(F.expr(_attributes(e, emit)).alias("attributes"), F.expr(_times(e, emit)).alias("times"))
            case = (F.col("rule") == n, guarded(both))
            values = F.when(*case) if values is None else values.when(*case)
    return values


def _result_columns(extractors: list[Extractor]) -> list[Column]:
    """The columns of a result row; those of guarded rules come from `_values`."""
    rules = _rules(extractors)
    plain = [r for r in rules if not r[1].guarded]
    own = {
        "container": _by_rule(rules, lambda e, emit: _quote(emit.container), "STRING"),
        "message": _by_rule(rules, lambda e, emit: emit.message and _quote(emit.message), "STRING"),
        "attributes": _by_rule(plain, _attributes, ATTRIBUTES),
        "times": _by_rule(plain, _times, TIMES),
    }
    chain = _by_rule(rules, lambda e, emit: _quote(e.chain), "STRING")
    guards = [n for n, e, _ in rules if e.guarded]
    if guards:
        size = len(rules)
        of_rule = F.col("rule").isin(guards)
        raised = (F.col("rule") >= size) | (of_rule & F.col("_values").isNull())
        reason = (
            F.when(F.col("rule") >= 2 * size, F.lit("content could not be cut"))
            .when(F.col("rule") >= size, F.lit("condition could not be computed"))
            .otherwise(F.lit("values could not be computed"))
        )
        own["container"] = F.when(raised, F.lit(EXTRACTION_ERROR)).otherwise(own["container"])
        own["message"] = F.when(raised, reason).otherwise(own["message"])
        for name, kind in (("attributes", ATTRIBUTES), ("times", TIMES)):
            none = F.expr(f"CAST({'map' if name == 'attributes' else 'array'}() AS {kind})")
            own[name] = F.when(raised, none).when(of_rule, F.col(f"_values.value.{name}")).otherwise(own[name])
        names = F.create_map(*[x for e in extractors for x in (F.lit(e.name), F.lit(e.chain))])
        chain = F.coalesce(chain, F.element_at(names, F.col("parser")))
    return [
        own["container"].alias("container"),
        F.col("path"),
        chain.alias("parser"),
        F.col("seq").cast("bigint").alias("seq"),
        *[own[c].alias(c) for c in ("message", "attributes", "times")],
    ]


def items_with_content(files: DataFrame, registry: Iterable[Extractor]) -> DataFrame:
    """Work items carrying what their extractor reads.

    Items of metadata extractors carry no bytes, so a later shuffle moves each
    file only for the extractors that open it.
    """
    registry = tuple(registry)
    items = work_items(files, registry, "name", "length", "mtime", "content")
    return items.withColumn("content", _content_for(e.name for e in registry if e.needs_content))


def _content_for(names: Iterable[str]) -> Column:
    """`content` for the items of these extractors, null for all others."""
    names = list(names)
    return F.when(F.col("parser").isin(names), F.col("content")) if names else F.lit(None).cast("binary")


def run_extractors(items: DataFrame, registry: Iterable[Extractor], seq: str | None = None) -> DataFrame:
    """Results of work items `(parser, path, name, length, mtime, content)`.

    All declared extractors share one pass: cut into records, dispatch by name,
    one row per emit rule that holds. Python extractors share one more. Where the
    items are pieces of files, `seq` names the column with the piece's number.
    """
    registry = tuple(registry)
    declared = [e for e in registry if e.python is None and e.emits]
    results = None
    if declared:
        cut_failed = F.lit(False)
        if any(e.records for e in declared):
            # Content already cut into records is not carried along beside each of them.
            cut = items.withColumns({
                "cut": _records(declared),
                "content": _content_for(e.name for e in declared if e.needs_content and not e.records),
            })
            kept = ["path", "parser", "name", "length", "mtime", "content", *([seq] if seq else [])]
            records = F.col("cut.value")
            if any(e.guarded and e.records for e in declared):
                cut_failed = F.col("cut_failed")
                cut = cut.withColumn("cut_failed", F.col("cut").isNull())
                records = F.coalesce(records, F.array(F.lit(None).cast("string")))
                kept.append("cut_failed")
            # An outer generator: for a plain one the optimizer adds a filter on the
            # number of records and so cuts the content a second time.
            rows = cut.select(*kept, F.posexplode_outer(records).alias("seq", "record")).where("seq IS NOT NULL")
        else:
            rows = items.withColumns({"seq": F.lit(0), "record": F.lit(None).cast("string")})
        if seq:
            rows = rows.withColumn("seq", F.col(seq))
        # Only rule numbers are exploded; what a rule yields is computed after
        # that, for the columns and containers the plan goes on with.
        fired = rows.withColumn("rule", F.explode(_fired(declared, cut_failed)))
        values = _guarded_values(declared)
        if values is not None:
            fired = fired.withColumn("_values", values)
        results = fired.select(*_result_columns(declared))
    functions = {e.name: e.python for e in registry if e.python is not None}
    if functions:
        mine = items.where(F.col("parser").isin(list(functions)))
        mine = mine.select(*PYTHON_COLUMNS, *[c for c in ("uri",) if c in items.columns])
        ran = mine.mapInArrow(run_python(functions), RESULTS)
        results = ran if results is None else results.unionByName(ran)
    return results


def extract_results(files: DataFrame, registry: Iterable[Extractor], partitions: int | None = None) -> DataFrame:
    """Files to events and warnings, optionally spread over `partitions` first."""
    registry = tuple(registry)
    if partitions:
        # Files are dealt out, not their items: content moves once however many extractors open it.
        files = spread(files, partitions, "path").drop("bucket")
    return run_extractors(items_with_content(files, registry), registry)


def flat(results: DataFrame) -> DataFrame:
    """Results with their single attribute as `attr`, `val` and their first time as `t`."""
    return results.select(
        "container", "path", "parser", "seq", "message",
        F.get(F.map_keys("attributes"), F.lit(0)).alias("attr"),
        F.get(F.map_values("attributes"), F.lit(0)).alias("val"),
        F.get("times", F.lit(0))["timestamp"].alias("t"),
    )
