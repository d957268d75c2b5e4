"""Search hints of JSON records, in the order of their leaves; and text differences of documents, in hunks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Parts of a key that promise a formula, terms of phases in the order that they are looked for, a group as `P 63/mmc`.
FORMULA_KEYS = ("formula", "composition", "material", "materials", "compound", "phase", "reported_materials", "materials_name", "reduced_formula")
PHASES = ("fcc", "bcc", "hcp", "cubic", "tetragonal", "orthorhombic", "monoclinic", "triclinic", "trigonal", "rhombohedral", "hexagonal")
GROUP = re.compile(r"\b([PIFRCA]\s*[0-9]{1,3}(?:/[A-Za-z0-9\-]+)?)\b", re.IGNORECASE)
WHOLE, TOKEN = re.compile(r"(?:[A-Z][a-z]?\d*){1,8}"), re.compile(r"\b(?:[A-Z][a-z]?\d*){1,8}\b")
MOST = 8


def leaves(node, path: str = "root") -> Iterator[tuple[str, object]]:
    """Paths and scalars of a parsed document in its own order, without recursion."""
    stack = [(path, node)]
    while stack:
        at, value = stack.pop()
        if isinstance(value, dict):
            stack += [(f"{at}.{k}", v) for k, v in reversed(value.items())]
        elif isinstance(value, list):
            stack += [(f"{at}[{i}]", v) for i, v in zip(range(len(value) - 1, -1, -1), reversed(value), strict=True)]
        else:
            yield at, value


def formula(value: str, names: dict[str, str]) -> str:
    """The symbol of an element's name, the text without blanks if it is a formula, else the longest one inside."""
    flat = value.strip()
    if flat.lower() in names:
        return names[flat.lower()]
    flat = flat.replace(" ", "")
    return flat if WHOLE.fullmatch(flat) else max(TOKEN.findall(flat), key=len, default="")


def hints_of(record: str | None, names: dict[str, str]) -> tuple[list[str], list[str], list[str]]:
    """Formulas, phases and groups of a record, eight of each at most.  The walk ends once all three are full; formulas come from
    keys that promise one, else from any text."""
    try:
        root = json.loads(record or "")
    except ValueError:
        return [], [], []
    formulas, phases, groups, anywhere = {}, {}, {}, {}
    for path, value in leaves(root):
        if value is None or not (text := str(value).strip()):
            continue
        if any(k in path.lower().rsplit(".", 1)[-1] for k in FORMULA_KEYS) and (found := formula(text, names)):
            formulas[found] = None
        elif not formulas and len(anywhere) < MOST and (found := formula(text, names)):
            anywhere[found] = None
        for found in GROUP.findall(text):
            groups[" ".join(found.split())] = None
        for term in PHASES:
            if term not in phases and re.search(rf"\b{term}\b", text.lower()):
                phases[term] = None
        if min(len(formulas), len(phases), len(groups)) >= MOST:
            break
    return tuple([*x][:MOST] for x in (formulas or anywhere, phases, groups))


def hints(rows: DataFrame, record: str, names: dict[str, str]) -> DataFrame:
    """The rows with formulas, phases and groups of their record (JSON), each a list of eight at most; what isn't JSON has none."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, formulas array<string>, phases array<string>, groups array<string>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [hints_of(x, names) for x in batch[record]]
            yield batch.assign(**{c: [f[i] for f in found] for i, c in enumerate(("formulas", "phases", "groups"))})

    return rows.mapInPandas(run, schema)


def search_defaults(material: Column, main: Column, formulas: Column, phases: Column, groups: Column) -> Column:
    """What a structure search begins with: the figure's material, else the paper's, else the first formula; the first phase and group."""
    first = lambda c: F.coalesce(F.get(c, F.lit(0)), F.lit(""))
    own = lambda c: F.nullif(F.trim(c), F.lit(""))
    return F.struct(F.coalesce(own(material), own(main), first(formulas)).alias("formula"), first(phases).alias("phase"), first(groups).alias("group"))


# ---- differences ------------------------------------------------------------------------------------------------------------


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The longest common subsequence of a with each beginning of b, a row of the table at a time."""
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        new = row.copy()
        np.maximum(row[1:], row[:-1] + (b == x), out=new[1:])
        row = np.maximum.accumulate(new)
    return row


def common(a: np.ndarray, b: np.ndarray, at: int = 0, to: int = 0) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, in memory that follows the lines: a is halved where both halves' sum is largest."""
    out, tasks = [], [(a, b, at, to)]
    while tasks:
        a, b, at, to = tasks.pop()
        n = min(len(a), len(b))
        same = a[:n] == b[:n]
        head = n if same.all() else int(np.argmin(same))
        out += [(at + i, to + i) for i in range(head)]
        a, b, at, to = a[head:], b[head:], at + head, to + head
        n = min(len(a), len(b))
        same = a[len(a) - n :][::-1] == b[len(b) - n :][::-1]
        tail = n if same.all() else int(np.argmin(same))
        out += [(at + len(a) - 1 - i, to + len(b) - 1 - i) for i in range(tail)]
        a, b = a[: len(a) - tail], b[: len(b) - tail]
        if not len(a) or not len(b):
            continue
        if len(a) == 1:
            found = np.flatnonzero(b == a[0])
            out += [(at, to + int(found[0]))] if len(found) else []
            continue
        half = len(a) // 2
        cut = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
        tasks += [(a[:half], b[:cut], at, to), (a[half:], b[cut:], at + half, to + cut)]
    return sorted(out)


def hunks(left: list[str], right: list[str], context: int = 3) -> list[tuple[int, int, int, int, list[str]]]:
    """(first left line, how many, first right line, how many, lines marked by blank, - and +), from 1; removed lines stand before
    added ones.  Changes with at most twice the context between them share a hunk."""
    number: dict[str, int] = {}
    a, b = (np.array([number.setdefault(x, len(number)) for x in lines], np.int64) for lines in (left, right))
    script, i, j = [], 0, 0
    for x, y in [*common(a, b), (len(left), len(right))]:
        script += [("-", k, j) for k in range(i, x)] + [("+", x, k) for k in range(j, y)]
        if x < len(left):
            script.append((" ", x, y))
        i, j = x + 1, y + 1
    changed = [k for k, s in enumerate(script) if s[0] != " "]
    out, at = [], 0
    while at < len(changed):
        to = at
        while to + 1 < len(changed) and changed[to + 1] - changed[to] - 1 <= 2 * context:
            to += 1
        part = script[max(0, changed[at] - context) : changed[to] + context + 1]
        lines = [m + (right[y] if m == "+" else left[x]) for m, x, y in part]
        out.append((part[0][1] + 1, sum(m != "+" for m, *_ in part), part[0][2] + 1, sum(m != "-" for m, *_ in part), lines))
        at = to + 1
    return out


def differences(pairs: DataFrame, key: str, left: str, right: str, context: int = 3) -> DataFrame:
    """(key, hunk, left_start, left_lines, right_start, right_lines, lines) of each pair of texts that differ by lines.

    A pair is a row's work, its cost the product of both texts' lines between their common head and tail; null is empty."""
    kind = pairs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, n, *h) for k, a, b in zip(batch[key], batch[left], batch[right], strict=True) for n, h in enumerate(hunks((a or "").split("\n") if a else [], (b or "").split("\n") if b else [], context))]
            yield pd.DataFrame(rows, columns=[key, "hunk", "left_start", "left_lines", "right_start", "right_lines", "lines"])

    return pairs.select(key, left, right).mapInPandas(run, f"`{key}` {kind}, hunk int, left_start int, left_lines int, right_start int, right_lines int, lines array<string>")
