"""Selectors: ``type[key op value and ...]`` over node tables, and row predicates over tables.

Nodes are rows (path, parent_path, ord, type, text, style, format map) of one tree, or of many trees told
apart by key columns such as file and part; ``pre`` and ``post`` number each tree's nodes so that a node's
descendants are those behind it up to its ``post``. Every leaf is two-valued, so that ``not`` keeps rows
whose key is missing.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridloom.functions.ordered import Fold, scan
from gridloom.operators.spelling import closest
from gridloom.staging import staged


class SelectorError(ValueError):
    pass


#: English metric units of a length, by unit, fixed values.
_EMU = {"pt": 12700.0, "px": 9525.0, "cm": 360000.0, "mm": 36000.0, "in": 914400.0, "em": 152400.0}
_SLACK = 500.0
_LEAF = re.compile(r"""\s*([\w.#\-]+|"[^"]*")\s*(?:(!=|~=|>=|<=|=|>|<)\s*(r"(?:[^"\\]|\\.)*"|"[^"]*"|'[^']*'|[^\s()\[\]]+(?:\s+(?!and\b|or\b)[^\s()\[\]]+)*))?""", re.I)


def _size(x: Column) -> Column:
    """A length with its unit in metric units, NULL for anything else."""
    unit = F.lower(F.regexp_extract(x, r"^\s*-?\d+(?:\.\d+)?\s*(pt|px|cm|mm|in|em)\s*$", 1))
    factor = F.try_element_at(F.create_map(*[F.lit(v) for kv in _EMU.items() for v in kv]), unit)
    return F.regexp_extract(x, r"^\s*(-?\d+(?:\.\d+)?)", 1).try_cast("double") * factor


def _measure(value: str) -> float | None:
    m = re.fullmatch(r"\s*(-?\d+(?:\.\d+)?)\s*(pt|px|cm|mm|in|em)\s*", value, re.I)
    return float(m[1]) * _EMU[m[2].lower()] if m else None


def _number(text: str) -> float | None:
    try:
        n = float(text.rstrip("%"))
    except ValueError:
        return None
    return n if n == n and abs(n) != float("inf") else None


def leaf(x: Column, op: str | None, raw: str | None) -> Column:
    """One comparison. Ordering needs numbers or lengths on both sides; ``!=`` holds for a missing key."""
    s = x.cast("string")
    if op is None:
        return F.coalesce(s.isNotNull() & (s != ""), F.lit(False))
    regex = raw.startswith('r"')
    value = raw[2:-1] if regex else raw[1:-1] if raw[:1] in "\"'" else raw
    if op == "~=":
        hit = F.rlike(s, F.lit("(?i)" + value)) if regex else F.lower(s).contains(value.lower())
        return F.coalesce(hit, F.lit(False))
    number, length = _number(value), _measure(value)
    plain = F.regexp_replace(s, "%$", "").try_cast("double")
    if op in ("=", "!="):
        same = F.lower(F.regexp_replace(s, "^#", "")) == re.sub("^#", "", value).lower()
        if number is not None:
            same = same | F.coalesce(plain == number, F.lit(False))
        if length is not None:
            same = same | F.coalesce(F.abs(_size(s) - length) <= _SLACK, F.lit(False))
        same = F.coalesce(same, F.lit(False))
        return same if op == "=" else ~same
    left, right = (_size(s), length) if length is not None else (plain, number)
    if right is None:
        return F.lit(False)
    test = {">": left > right, "<": left < right, ">=": left >= right, "<=": left <= right}[op]
    return F.coalesce(test, F.lit(False))


def condition(text: str, resolve: Callable[[str], Column]) -> Column:
    """``a > 1 and (b = x or not(c))`` as a predicate; ``and`` binds tighter than ``or``."""
    at = 0

    def word(w: str) -> bool:
        nonlocal at
        m = re.compile(rf"\s*{w}(?=[\s(\[]|$)", re.I).match(text, at) if w.isalpha() else re.compile(rf"\s*{re.escape(w)}").match(text, at)
        if m:
            at = m.end()
        return m is not None

    def either() -> Column:
        out = both()
        while word("or"):
            out = out | both()
        return out

    def both() -> Column:
        out = one()
        while word("and"):
            out = out & one()
        return out

    def one() -> Column:
        nonlocal at
        if word("not"):
            return ~one()
        if word("("):
            out = either()
            if not word(")"):
                raise SelectorError(f"missing ) in {text!r}")
            return out
        m = _LEAF.match(text, at)
        if not m or not m[1]:
            raise SelectorError(f"expected a condition at {text[at:]!r}")
        at = m.end()
        return leaf(resolve(m[1].strip('"')), m[2], m[3])

    out = either()
    if text[at:].strip():
        raise SelectorError(f"unexpected {text[at:]!r}")
    return out


def suggest(name: str, names: list[str]) -> str:
    near = closest(name, names, max(2, len(name) // 3))
    return f"; did you mean {near!r}?" if near else ""


def column_of(df: DataFrame, name: str) -> Column:
    """A column by name without case, by ``col.`` and name, or by its letter."""
    bare = re.sub(r"^col\.", "", name, flags=re.I)
    hits = [c for c in df.columns if c.lower() == bare.lower()]
    if len(hits) > 1 and bare not in hits:
        raise SelectorError(f"{name!r} is ambiguous: {', '.join(hits)}")
    if hits:
        return F.col(f"`{bare if bare in hits else hits[0]}`")
    if re.fullmatch("[A-Za-z]{1,3}", bare):
        n = 0
        for ch in bare.upper():
            n = n * 26 + ord(ch) - 64
        if n <= len(df.columns):
            return F.col(f"`{df.columns[n - 1]}`")
    raise SelectorError(f"no column {name!r}{suggest(bare, df.columns)}")


def where_rows(df: DataFrame, selector: str) -> DataFrame:
    """Rows of a table by ``row[...]``; comma-joined selectors give each row once, stacked brackets are AND."""
    out = None
    for part in _split(selector):
        m = re.fullmatch(r"\s*(?:[^!\[]*!)?row((?:\[.*\])?)\s*", part, re.S)
        if not m:
            raise SelectorError(f"not a row selector: {part!r}")
        test = F.lit(True)
        for body in _brackets(m[1]):
            test = test & condition(body, lambda n: column_of(df, n))
        out = test if out is None else out | test
    return df.where(out)


def _split(selector: str) -> list[str]:
    """Parts between commas that stand outside brackets."""
    parts, depth, quoted = [""], 0, ""
    for ch in selector:
        quoted = "" if ch == quoted else ch if not quoted and ch in "\"'" else quoted
        depth += (ch == "[") - (ch == "]") if not quoted else 0
        if ch == "," and not depth and not quoted:
            parts.append("")
        else:
            parts[-1] += ch
    return parts


def _brackets(text: str) -> list[str]:
    out, depth = [], 0
    for ch in text:
        if ch == "]":
            depth -= 1
        if depth:
            out[-1] += ch
        if ch == "[":
            if not depth:
                out.append("")
            depth += 1
    return out


def _node_column(name: str) -> Column:
    fields = {"type", "text", "style", "path", "ord"}
    if name.lower() in ("value", "text"):
        return F.col("text")
    return F.col(name.lower()) if name.lower() in fields else F.try_element_at("format", F.lit(name))


def _step(nodes: DataFrame, step: str, keys: list[str]) -> DataFrame:
    m = re.fullmatch(r"\s*([\w*]+)?((?:\s*\[.*\])?)((?::[\w-]+(?:\([^)]*\))?)*)\s*", step, re.S)
    if not m or not step.strip():
        raise SelectorError(f"not a selector: {step!r}")
    out = nodes if m[1] in (None, "*") else nodes.where(F.lower("type") == m[1].lower())
    for body in _brackets(m[2]):
        if re.fullmatch(r"\d+|last\(\)", body.strip()):
            w = Window.partitionBy(*keys, "parent_path").orderBy("ord" if body.strip().isdigit() else F.desc("ord"))
            out = out.withColumn("__n", F.row_number().over(w)).where(F.col("__n") == (int(body) if body.strip().isdigit() else 1)).drop("__n")
        else:
            out = out.where(condition(body, _node_column))
    for name, value in re.findall(r":([\w-]+)(?:\(([^)]*)\))?", m[3]):
        value = value.strip("\"'")
        tests = {
            "contains": lambda: F.lower(F.coalesce("text", F.lit(""))).contains(value.lower()),
            "empty": lambda: F.coalesce("text", F.lit("")) == "",
            "has": lambda: F.coalesce(F.try_element_at("format", F.lit(value)), F.lit("")) != "",
            "not": lambda: ~condition(value, _node_column),
        }
        if name not in tests:
            raise SelectorError(f"no pseudo-class {name!r}{suggest(name, list(tests))}")
        out = out.where(tests[name]())
    return out


def tree_keys(nodes: DataFrame, keys: list[str] | None = None) -> list[str]:
    """The columns that tell trees apart: those given, or file, part and sheet where there are any."""
    return [c for c in ("file", "part", "sheet") if c in nodes.columns] if keys is None else list(keys)


def inside(nodes: DataFrame, found: DataFrame, keys: list[str], spread: bool = False) -> DataFrame:
    """``nodes`` that stand below any of ``found``.

    Both are laid in document order; a node is inside if the furthest ``post`` of the ``found`` before it
    reaches it. Each tree is one group of a window; with ``spread``, or without keys, the order is cut into
    stretches that hand the furthest end on, for trees that fill many tasks.
    """
    opened = found.select(*keys, F.col("pre").alias("__at"), F.lit(1).alias("__kind"), F.col("post").alias("__reach"))
    own = nodes.select(*keys, F.col("pre").alias("__at"), F.lit(0).alias("__kind"), F.lit(None).cast(nodes.schema["post"].dataType).alias("__reach"), F.struct(*[F.col(f"`{c}`") for c in nodes.columns]).alias("__node"))
    both = own.unionByName(opened, allowMissingColumns=True)
    if spread or not keys:
        both = scan(both, ["__at", "__kind"], {"__end": Fold("max", F.col("__reach"))}, keys)
    else:
        w = Window.partitionBy(*keys).orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
        both = both.withColumn("__end", F.max("__reach").over(w))
    return both.where(F.col("__node").isNotNull() & (F.col("__end") >= F.col("__at"))).select("__node.*")


def select_nodes(nodes: DataFrame, selector: str, keys: list[str] | None = None, spread: bool = False) -> DataFrame:
    """Nodes by selectors, each once.

    ``a > b`` or ``a/b`` takes children, ``a b`` or ``a//b`` descendants (which needs ``pre`` and ``post``,
    see ``label_nodes``); ``/a`` starts at the roots, ``//a`` anywhere. ``[N]`` and ``[last()]`` count among
    the nodes of a parent that fit so far. Commas give the union. Steps never leave a tree: trees are told
    apart by ``keys``, by default by file, part and sheet.
    """
    keys, out = tree_keys(nodes, keys), None
    for part in _split(selector):
        found = None
        for relation, step in path_steps(part):
            if found is None:
                start = nodes.where(F.col("parent_path") == "/") if relation == "root" else nodes
                found = _step(start, step, keys)
            elif relation == "child":
                parents = found.select(*keys, F.col("path").alias("parent_path")).distinct()
                found = _step(nodes.join(parents, [*keys, "parent_path"], "left_semi").select(nodes.columns), step, keys)
            else:
                if "pre" not in nodes.columns or "post" not in nodes.columns:
                    raise SelectorError("descendant steps need the columns pre and post; label_nodes makes them")
                found = _step(inside(nodes, found, keys, spread), step, keys)
        out = found if out is None else out.unionByName(found)
    return out.dropDuplicates([*keys, "path"])


def path_steps(part: str) -> list[tuple[str, str]]:
    """(relation to the step before, step): root or any for the first one, then child or descendant."""
    steps, relation, step, depth, quoted, at = [], "any", "", 0, "", 0
    text = part.strip()
    while at < len(text):
        ch = text[at]
        quoted = "" if ch == quoted else ch if not quoted and ch in "\"'" else quoted
        depth += ((ch in "[(") - (ch in "])")) if not quoted else 0
        m = None if depth or quoted else re.compile(r"\s*(//|/|>)\s*|\s+(?![\[:\s])").match(text, at)
        if m:
            if step.strip():
                steps.append((relation, step))
            elif steps or m[1] == ">":
                raise SelectorError(f"a step is missing in {part!r}")
            relation = {"//": "descendant", None: "descendant"}.get(m[1], "child")
            if not steps and not step.strip():
                relation = "root" if m[1] == "/" else "any"
            step, at = "", m.end()
            continue
        step, at = step + ch, at + 1
    if not step.strip():
        raise SelectorError(f"a step is missing in {part!r}")
    return [*steps, (relation, step)]


def label_nodes(nodes: DataFrame, keys: list[str] | None = None, id: str = "path", parent: str = "parent_path", ord: str = "ord", deepest: int = 32) -> DataFrame:
    """``nodes`` with ``pre``, ``post`` and ``depth``, from each node's parent and its place among its siblings.

    Levels are joined from the roots (whose parent no node is) down, each handing on the places from the
    root, whose order is the document's; sizes of subtrees are counted by the places' beginnings. Places
    among siblings count from 0 or 1. Nodes below ``deepest`` levels, or in cycles, are an error. Levels and
    result are written to the shared folder when the plan is made.
    """
    keys = tree_keys(nodes, keys)
    slim = nodes.select(*keys, F.col(id).alias("__id"), F.col(parent).alias("__up"), F.col(ord).cast("bigint").alias("__ord"))
    own = F.lpad(F.hex("__ord"), 8, "0")
    level = slim.join(slim.select(*keys, F.col("__id").alias("__up")), [*keys, "__up"], "left_anti").select(*keys, "__id", own.alias("__place"), F.lit(0).alias("depth"))
    levels, n = [staged(level, "level")], slim.count()
    held = levels[0].count()
    while held < n:
        above = levels[-1].select(*keys, F.col("__id").alias("__up"), F.col("__place").alias("__above"), "depth")
        below = slim.join(above, [*keys, "__up"]).select(*keys, "__id", F.concat("__above", own).alias("__place"), (F.col("depth") + 1).alias("depth"))
        levels.append(staged(below, "level"))
        more = levels[-1].count()
        if not more or len(levels) > deepest:
            raise ValueError("a tree is too deep, or has a cycle")
        held += more
    placed = reduce(DataFrame.unionByName, levels)
    order = scan(placed, ["__place"], {"pre": Fold("count", F.lit(1))}, keys).withColumn("pre", F.col("pre") - 1)
    steps = F.sequence(F.lit(1), (F.length("__place") / 8).cast("int"))
    sizes = order.select(*keys, F.explode(F.transform(steps, lambda i: F.substring("__place", F.lit(1), i * 8))).alias("__place")).groupBy(*keys, "__place").agg(F.count("*").alias("__size"))
    labelled = order.join(sizes, [*keys, "__place"]).select(*keys, F.col("__id").alias(id), "pre", (F.col("pre") + F.col("__size") - 1).alias("post"), "depth")
    kept = [c for c in nodes.columns if c not in ("pre", "post", "depth")]
    return staged(nodes.select(*kept).join(labelled, [*keys, id]).select(*kept, "pre", "post", "depth"), "labelled")


def sheet_nodes(cells: DataFrame) -> DataFrame:
    """Cells of workbooks as trees of sheet, row and cell nodes, a tree for each file and sheet.

    Places come from the row and column numbers, so no order has to be made: rows of up to 16,384 columns.
    """
    width, base = F.lit(1 << 15), ["file", "sheet"]
    path = F.concat(F.lit("/"), F.col("sheet"))
    row_path = F.concat(path, F.lit("/row["), F.col("row").cast("string"), F.lit("]"))
    form = F.map_filter(F.create_map(F.lit("kind"), F.col("kind"), F.lit("formula"), F.col("formula")), lambda k, v: v.isNotNull())
    none = F.lit(None).cast("string")
    made = lambda *c: F.struct(*[x.alias(n) for x, n in zip(c, ("path", "parent_path", "ord", "type", "text", "style", "format", "pre", "post", "depth"))])
    cell = cells.select(*base, made(F.concat(row_path, F.lit("/cell["), F.col("col").cast("string"), F.lit("]")), row_path, F.col("col"), F.lit("cell"), F.col("text"), none, form, F.col("row") * width + F.col("col"), F.col("row") * width + F.col("col"), F.lit(2)).alias("n"))
    empty = F.create_map().cast("map<string,string>")
    row = cells.select(*base, "row").distinct().select(*base, made(row_path, path, F.col("row"), F.lit("row"), none, none, empty, F.col("row") * width, F.col("row") * width + width - 1, F.lit(1)).alias("n"))
    sheet = cells.groupBy(*base).agg(F.max("row").alias("row")).select(*base, made(path, F.lit("/"), F.lit(1).cast("bigint"), F.lit("sheet"), none, none, empty, F.lit(0).cast("bigint"), F.col("row") * width + width - 1, F.lit(0)).alias("n"))
    return cell.unionByName(row).unionByName(sheet).select(*base, "n.*")
