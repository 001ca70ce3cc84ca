"""Extraction from captured search pages.

Input is a table of pages ``(page_id, url, html)``.  Everything is regular
expressions over the HTML text, run JVM-side per row, then ``explode``:

- R1 result grid: rows ``<tr ... class="jqgrow ...">`` of the result table,
  cells addressed by ``aria-describedby="<grid>_<COLUMN>"``.  The item cell
  ``[3304991000] name`` splits into ``hs_code`` and ``item_name``; numbers
  lose their thousands separators.
- R2 option lists: ``<select id=..>`` -> ``<optgroup label=..>`` ->
  ``<option value=..>label</option>`` rows ``(select_id, grp, code, label)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the portal's result grid: its table id and column ids, in
# grid order (number, item, region, export amount/weight, import amount/weight).
GRID_ID = "table_list_1"
GRID_COLUMNS = ["NUM", "COL1", "COL2", "EX_AMT", "EX_WGHT", "IM_AMT", "IM_WGHT"]

_ROW_RE = r'(?s)(<tr\b[^>]*?\bclass="[^"]*?\bjqgrow\b[^>]*>(?:[^<]++|<(?!/tr>))*+</tr>)'
_SELECT_RE = r'(?s)(<select\b[^>]*>.*?</select>)'


# Separators that never occur in HTML text: cell start and key/value split.
_CELL_SEP = "\u0001"
_KEY_SEP = "\u0002"
_TRIM = " \t\r\n"


def _flat(row: Column, grid: str) -> Column:
    """A grid row as ``\x01<column id>\x02<cell text>...`` in one pass: a cell's
    opening tag becomes its id between the marks, other tags become empty marks,
    which go.  Values keep surrounding whitespace; see ``_text``."""
    tag = rf'<td\b[^>]*?aria-describedby="{grid}_([A-Za-z0-9_]+)"[^>]*>|<[^>]*>'
    marked = F.regexp_replace(row, tag, f"{_CELL_SEP}$1{_KEY_SEP}")
    return F.replace(marked, F.lit(_CELL_SEP + _KEY_SEP), F.lit(""))


def _cell(flat: Column, name: str) -> Column:
    """Text of the last cell with that column id (NULL without one)."""
    key = f"{_CELL_SEP}{name}{_KEY_SEP}"
    value = F.substring_index(F.substring_index(flat, key, -1), _CELL_SEP, 1)
    return F.when(F.contains(flat, F.lit(key)), value)


def _text(value: Column) -> Column:
    return F.trim(value, F.lit(_TRIM))


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double")


# Named entities; ``&amp;`` comes last, so nothing is decoded twice.
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}


def _unescape(c: Column) -> Column:
    """Decodes named and numeric entities (decimal and hexadecimal)."""
    parts = F.regexp_extract_all(c, F.lit(r"(?s)(&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|[^&]+|&)"), 1)

    def decoded(x: Column) -> Column:
        hexa = F.conv(F.regexp_extract(x, r"^&#[xX]([0-9A-Fa-f]+);$", 1), 16, 10)
        code = F.coalesce(F.regexp_extract(x, r"^&#([0-9]+);$", 1).try_cast("int"), hexa.try_cast("int"))
        bits = F.lpad(F.hex(code.cast("long")), 8, "0")  # UTF-32, big endian
        return F.when(code.between(1, 0x10FFFF), F.decode(F.unhex(bits), "UTF-32")).otherwise(x)

    plain = F.when(F.contains(c, F.lit("&#")), F.array_join(F.transform(parts, decoded), "")).otherwise(c)
    for entity, char in _ENTITIES.items():
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.when(F.contains(c, F.lit("&")), plain).otherwise(c)


def grid_rows(pages: DataFrame, grid: str = GRID_ID) -> DataFrame:
    """One row per result-grid row of every page.

    Output: ``page_id, row_num, hs_code, item_name, region, ex_amt, ex_wght,
    im_amt, im_wght``.
    """
    rows = pages.select("page_id", F.explode(F.regexp_extract_all(F.col("html"), F.lit(_ROW_RE), 1)).alias("_tr"))
    flat = rows.select("page_id", _flat(F.col("_tr"), grid).alias("_f"))
    # Every cell is cut out once and decoded once, in a column of its own.
    cells = flat.select("page_id", *[_text(_cell(F.col("_f"), c)).alias(f"_{c}") for c in GRID_COLUMNS])
    decoded = cells.withColumns({"_COL1": _unescape(F.col("_COL1")), "_COL2": _unescape(F.col("_COL2"))})
    numbered = F.col("_COL1").rlike(r"^\[[0-9]+\]")
    code = F.substring_index(F.substring("_COL1", 2, 1 << 30), "]", 1)
    name = F.ltrim(F.expr("substring(_COL1, instr(_COL1, ']') + 1)"), F.lit(_TRIM))
    return decoded.select(
        "page_id",
        F.col("_NUM").try_cast("long").alias("row_num"),
        F.when(numbered, code).when(F.col("_COL1").isNotNull(), F.lit("")).alias("hs_code"),
        F.when(numbered, name).otherwise(F.col("_COL1")).alias("item_name"),
        F.col("_COL2").alias("region"),
        *[_number(F.col(f"_{c}")).alias(c.lower()) for c in GRID_COLUMNS[3:]],
    )


def option_dimension(pages: DataFrame) -> DataFrame:
    """R2: ``(page_id, select_id, grp, code, label)`` for every ``<option>``
    with a non-empty value; ``grp`` is the enclosing ``<optgroup>`` label or NULL."""
    sel = pages.select(
        "page_id", F.explode(F.regexp_extract_all(F.col("html"), F.lit(_SELECT_RE), 1)).alias("_sel")
    ).select(
        "page_id",
        F.regexp_extract(F.col("_sel"), r'<select\b[^>]*\bid="([^"]*)"', 1).alias("select_id"),
        F.col("_sel"),
    )
    # One pass over the select: group starts, group ends and options in order;
    # an option's group is that of the last start or end before it.
    token = r'(?s)(<optgroup\b[^>]*>|</optgroup>|<option\b[^>]*>.*?</option>)'
    tokens = F.regexp_extract_all(F.col("_sel"), F.lit(token), 1)
    state = F.struct(F.lit(None).cast("string").alias("grp"), F.array().cast("array<struct<grp:string,opt:string>>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        option = t.startswith("<option")
        label = F.when(t.startswith("<optgroup"), F.regexp_extract(t, r'\blabel="([^"]*)"', 1))
        grp = F.when(option, acc["grp"]).otherwise(label)
        more = F.array(F.struct(acc["grp"].alias("grp"), t.alias("opt")))
        return F.struct(grp.alias("grp"), F.when(option, F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"))

    opts = sel.select("page_id", "select_id", F.explode(F.aggregate(tokens, state, step)["out"]).alias("o"))
    opt = F.col("o.opt")
    return opts.select(
        "page_id",
        "select_id",
        _unescape(F.col("o.grp")).alias("grp"),
        _unescape(F.regexp_extract(opt, r'<option\b[^>]*\bvalue="([^"]*)"', 1)).alias("code"),
        F.regexp_replace(_unescape(F.regexp_replace(opt, r"<[^>]*>", "")), r"(?U)^\s+|\s+$", "").alias("label"),
    ).where(F.col("code") != "")


def list_links(pages: DataFrame) -> DataFrame:
    """R2 over plain lists: ``(page_id, code, label)`` of every ``<li>`` link of
    a page, ``code`` the link's target."""
    item = r'(?s)(<li\b[^>]*>\s*<a\b[^>]*\bhref="[^"]*"[^>]*>.*?</a>)'
    items = pages.select("page_id", F.explode(F.regexp_extract_all(F.col("html"), F.lit(item), 1)).alias("_li"))
    li = F.col("_li")
    return items.select(
        "page_id",
        _unescape(F.regexp_extract(li, r'\bhref="([^"]*)"', 1)).alias("code"),
        F.regexp_replace(_unescape(F.regexp_replace(li, r"<[^>]*>", "")), r"(?U)^\s+|\s+$", "").alias("label"),
    )
