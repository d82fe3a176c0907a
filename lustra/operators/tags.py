"""Masks that follow their columns: tags set by a policy at the source, resolved at the end.

A tag is column metadata, which Spark carries through filters, joins, selections and
renames, and keeps in stored tables. So masks may be applied after any number of such
steps, under whatever names the columns have by then::

    tagged = tag_tables({"crm.customers_silver": customers, "crm.leads": leads}, policy)
    report = tagged["crm.customers_silver"].withColumnRenamed("email", "contact").join(...)
    masked = mask_tagged(report, level, policy)

A value computed from a tagged column is a new column without a tag. The frame's plan
tells where each column comes from, and such a column raises unless :func:`declassify`
says that it may be shown (a count, a domain name).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lustra.operators.masking import DEFAULT_POLICY, ColumnMask, MaskPolicy, policy_key

TAG, RELEASED, COMPANION = "pii_mask", "pii_released", "pii_companion"
_LEVEL = "__level"


class Uncovered(LookupError):
    """Tables without a policy, or policies without their columns."""


def tag_columns(df: DataFrame, table_name: str, policy: MaskPolicy = DEFAULT_POLICY) -> DataFrame:
    """Tag a table's columns as its policy says; all of the policy's columns must be there.

    A column that a mask reads besides the masked one is marked too, so it is found again after
    a rename. Metadata that columns have already stays.
    """
    return tag_tables({table_name: df}, policy)[table_name]


def tag_tables(
    tables: Mapping[str, DataFrame], policy: MaskPolicy = DEFAULT_POLICY, on_missing: str = "raise"
) -> dict[str, DataFrame]:
    """Tag a list of tables; everything that isn't covered is raised at once, before any is tagged.

    ``on_missing="keep"`` leaves tables without a policy as they are, but a column
    that a policy names and a table lacks still raises.
    """
    wrong = []
    for name, df in tables.items():
        masks = policy.get(policy_key(name))
        if masks is None:
            if on_missing != "keep":
                wrong.append(f"no mask policy covers {name}")
            continue
        needed = {*masks, *(c for mask in masks.values() for c in (mask.using or {}).values())}
        lacking = sorted(needed - set(df.columns))
        if lacking:
            wrong.append(f"{name} lacks {', '.join(lacking)}")
    if wrong:
        raise Uncovered("; ".join(wrong))
    return {name: _tagged(df, policy_key(name), policy.get(policy_key(name), {})) for name, df in tables.items()}


def _tagged(df: DataFrame, key: str, masks: Mapping[str, ColumnMask]) -> DataFrame:
    marks: dict[str, dict] = {}
    for name, mask in masks.items():
        marks.setdefault(name, {})[TAG] = f"{key}.{name}"
        for other in (mask.using or {}).values():
            served = marks.setdefault(other, {}).setdefault(COMPANION, [])
            served.append(f"{key}.{name}.{other}")
    for name, mark in marks.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, **mark})
    return df


def declassify(df: DataFrame, *columns: str) -> DataFrame:
    """Say of computed columns that they may be shown. Tagged columns can't be released."""
    for name in columns:
        known = df.schema[name].metadata
        if TAG in known:
            raise ValueError(f"{name} is masked by policy and can't be released")
        df = df.withMetadata(name, {**known, RELEASED: True})
    return df


def mask_tagged(df: DataFrame, level: str | Column = "access_level", policy: MaskPolicy = DEFAULT_POLICY) -> DataFrame:
    """Mask every tagged column, in one projection. Tags are gone afterwards.

    Raises for columns computed from tagged ones that nothing releases, and for tags of
    another policy. A mask whose further column was dropped on the way does without it.
    """
    unclear = derived_columns(df)
    if unclear:
        raise Uncovered(f"computed from masked columns and not declassified: {', '.join(unclear)}")
    companions: dict[str, str] = {}
    for field in df.schema:
        for served in field.metadata.get(COMPANION, ()):
            companions.setdefault(served, field.name)
    held = df.withColumn(_LEVEL, F.col(level) if isinstance(level, str) else level)
    shown = []
    for field in df.schema:
        mark = {k: v for k, v in field.metadata.items() if k not in (TAG, RELEASED, COMPANION)}
        column = F.col(_quoted(field.name))
        tag = field.metadata.get(TAG)
        if tag is not None:
            column = _mask_of(tag, policy, companions, column)
        shown.append(column.alias(field.name, metadata=mark))
    return held.select(*shown)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _mask_of(tag: str, policy: MaskPolicy, companions: Mapping[str, str], column: Column) -> Column:
    key, _, name = tag.partition(".")
    mask = policy.get(key, {}).get(name)
    if mask is None:
        raise Uncovered(f"the policy has no mask for {tag}")
    using = {arg: companions.get(f"{tag}.{other}") for arg, other in (mask.using or {}).items()}
    extra = {arg: F.col(_quoted(found)) for arg, found in using.items() if found is not None}
    return mask.fn(column, F.col(_LEVEL), **extra)


# --- lineage -----------------------------------------------------------------


def derived_columns(df: DataFrame) -> list[str]:
    """Columns without a tag whose values come from tagged ones, by the frame's analyzed plan.

    Where a step doesn't say which of its inputs a new column is made of, all of them count.
    """
    plan = df._jdf.queryExecution().analyzed()
    sources: dict[int, set[int]] = {}
    tagged: set[int] = set()
    released: set[int] = set()
    todo = [plan]
    while todo:
        node = todo.pop()
        children = list(_items(node.children()))
        todo += children
        given = {a.exprId().id() for child in children for a in _items(child.output())}
        made: dict[int, set[int]] = {}
        for expression in _items(node.expressions()):
            if expression.getClass().getSimpleName() == "Alias":
                refs = {a.exprId().id() for a in _items(expression.child().references().toSeq())}
                made[expression.exprId().id()] = refs | _in_subqueries(expression, tagged)
        outputs = list(_items(node.output()))
        for place, a in enumerate(outputs):
            own, mark = a.exprId().id(), a.metadata()
            if mark.contains(TAG):
                tagged.add(own)
            elif mark.contains(RELEASED):
                released.add(own)
            elif own not in given and children:
                beside = {x.output().apply(place).exprId().id() for x in children if x.output().size() == len(outputs)}
                merged = node.getClass().getSimpleName() in ("Union", "Intersect", "Except")
                made.setdefault(own, beside if merged else given)
        for own, refs in made.items():
            sources.setdefault(own, set()).update(refs)
    stained: set[int] = set()
    grown = True
    while grown:
        more = {c for c, refs in sources.items() if c not in stained | tagged | released and refs & (stained | tagged)}
        grown = bool(more)
        stained |= more
    return [a.name() for a in _items(plan.output()) if a.exprId().id() in stained]


def _in_subqueries(expression, tagged: set[int]) -> set[int]:
    """Columns that a subquery inside an expression returns."""
    found: set[int] = set()
    todo = [expression]
    while todo:
        e = todo.pop()
        todo += _items(e.children())
        if "Subquery" in e.getClass().getSimpleName():
            outputs = list(_items(e.plan().output()))
            tagged |= {a.exprId().id() for a in outputs if a.metadata().contains(TAG)}
            found |= {a.exprId().id() for a in outputs}
    return found


def _items(seq) -> Iterable:
    return (seq.apply(i) for i in range(seq.size()))
