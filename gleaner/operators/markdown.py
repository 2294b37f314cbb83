"""Markdown at corpus scale: sections and pipe tables as rows.

Everything happens inside the document's row: lines are classified with array functions, so nothing
is shuffled and no window has to hold a document's lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import decode_lossy
from .rows import explode_rows

_LINE = "struct<at:int,level:int,title:string,text:string,skip:boolean,pipe:boolean>"
# Heading underlines, heading marks and the cells of a table's rule, as in CommonMark and GFM.
_SETEXT_1 = r"^={3,}\\s*$"
_SETEXT_2 = r"^-{3,}\\s*$"
_ATX = r"^(#{1,6})\\s+(.*)"
_RULE = r"^:?-+:?$"
_BLANKS = r" \t\r\u000c\u000b"


def classify_lines(df: DataFrame, body: str, out: str = "lines") -> DataFrame:
    """Array of lines: heading level (0: none) and title, or text; ``skip`` marks underlines."""
    split = df.withColumn("__l", F.split(decode_lossy(F.col(body)), "\n", -1))
    strip = lambda s: f"btrim({s}, '{_BLANKS}')"
    # 1: an underline below this line makes it a heading; underlines are consumed from the top down
    under = (
        f"transform(__l, (s, i) -> case when {strip('s')} = '' then 0 "
        f"when rlike(coalesce(get(__l, i + 1), ''), '{_SETEXT_1}') then 1 "
        f"when rlike(coalesce(get(__l, i + 1), ''), '{_SETEXT_2}') and not startswith({strip('s')}, '|') then 2 else 0 end)"
    )
    marked = split.withColumn("__u", F.expr(under))
    # an underline that was used cannot itself be a heading
    used = (
        "aggregate(__u, cast(array() as array<boolean>), "
        "(acc, u) -> concat(acc, array(if(size(acc) > 0 and element_at(acc, -1), false, u > 0))))"
    )
    plain = F.expr("not exists(__u, u -> u > 0)")
    marked = marked.withColumn("__h", F.when(plain, F.expr("transform(__u, u -> false)")).otherwise(F.expr(used)))
    line = (
        "transform(__l, (s, i) -> cast(struct(i, "
        f"case when get(__h, i) then get(__u, i) when rlike(s, '{_ATX}') then length(regexp_extract(s, '{_ATX}', 1)) else 0 end, "
        f"case when get(__h, i) then {strip('s')} when rlike(s, '{_ATX}') then {strip(f'''regexp_extract(s, '{_ATX}', 2)''')} end, "
        "s, i > 0 and get(__h, i - 1), "
        f"startswith({strip('s')}, '|') and contains(substring({strip('s')}, 2), '|')) as {_LINE}))"
    )
    return marked.withColumn(out, F.expr(line)).drop("__l", "__u", "__h")


def markdown_sections(df: DataFrame, body: str, *ids: str) -> DataFrame:
    """One row per section: its number, level, title, the number of the section around it, its own
    text without tables. Section 0 is the text before the first heading."""
    lined = classify_lines(df, body).select(*ids, "lines")
    heads = "concat(array(cast(struct(-1, 0, null, null, false, false) as " + _LINE + ")), filter(lines, l -> l.level > 0 and not l.skip))"
    sections = lined.withColumn("__heads", F.expr(heads))
    own = (
        "array_join(transform(filter(slice(lines, h.at + 2, coalesce(get(__heads, i + 1).at, size(lines)) - h.at - 1), "
        "l -> not l.skip and not l.pipe), l -> l.text), '\\n')"
    )
    parent = "coalesce(array_max(transform(sequence(0, i), j -> if(get(__heads, j).level < h.level, j, null))), 0)"
    rows = f"transform(__heads, (h, i) -> named_struct('section', i, 'level', h.level, 'title', h.title, 'parent', if(i = 0, null, {parent}), 'text', btrim({own}, '{_BLANKS}\\n')))"
    return explode_rows(sections, ids, F.expr(rows), "s").select(*ids, "s.*")


def markdown_tables(df: DataFrame, body: str, *ids: str) -> DataFrame:
    """One row per data row of every pipe table: table number, row number and its cells as a map.

    A run of pipe lines is a table if its second line is a rule of dashes; short rows are padded.
    """
    lined = classify_lines(df, body).select(*ids, F.expr("filter(lines, l -> l.pipe and l.level = 0 and not l.skip)").alias("__p"))
    starts = "filter(transform(__p, (l, i) -> if(i = 0 or get(__p, i - 1).at < l.at - 1, i, null)), x -> x is not null)"
    runs = lined.withColumn("__s", F.expr(starts))
    run = "transform(__s, (s, k) -> slice(__p, s + 1, coalesce(get(__s, k + 1), size(__p)) - s).text)"
    cells = lambda s: f"transform(split(regexp_replace({s}, '^[|]+|[|]+$', ''), '[|]', -1), c -> btrim(c, '{_BLANKS}'))"
    tables = (
        explode_rows(runs, ids, F.expr(run), "__lines", "__t")
        .filter(F.size("__lines") >= 3)
        .withColumn("__names", F.expr(f"filter({cells('get(__lines, 0)')}, c -> c != '')"))
        .filter((F.size("__names") > 0) & F.expr(f"forall({cells('get(__lines, 1)')}, c -> c = '' or rlike(c, '{_RULE}'))"))
    )
    data = F.expr("slice(__lines, 3, size(__lines) - 2)")
    rows = explode_rows(tables.withColumnRenamed("__t", "table"), [*ids, "table", "__names"], data, "__line", "row")
    padded = f"transform(__names, (n, i) -> coalesce(get({cells('__line')}, i), ''))"
    # of columns with the same name the last counts
    values = F.expr(
        f"map_from_arrays(array_distinct(__names), transform(array_distinct(__names), n -> "
        f"get({padded}, size(__names) - cast(array_position(reverse(__names), n) as int))))"
    )
    return rows.select(*ids, "table", "row", values.alias("cells"))
