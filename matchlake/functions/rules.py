"""Load rules applied to text cells on their way into a typed table.

These re-express the warehouse COPY options as SQL expressions, one per column:

* blanks as NULL   -- a cell of white space only becomes NULL.
* empty as NULL    -- done by the CSV reader itself for quoted and unquoted
  empty cells (see ``matchlake.sources.csv``).
* truncate columns -- text longer than a column's given length is cut; a column
  without a given length is never cut.
* typed parse      -- text to the column type.  An integer column also takes a
  decimal text with a zero fraction ("1.0"), the form in which pandas writes an
  integer column that holds a NULL.  Any other cell that does not parse fails
  the load, as COPY without an error allowance does.

A wide projection is handed to the JVM in one ``selectExpr`` call (a Column
object per cell rule would cost a dozen Py4J calls per column).  Whole-stage code
would make the rules of all columns one method, longer than the 8,000 bytes that the
JVM compiles, so it would run interpreted.  A higher-order function (in the message of
a cell that fails) keeps the projection out of it, and then it is cut into methods of
compiled size: half the time a row.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Characters counted as white space by the blank rule
# (space, tab, line feed, carriage return, vertical tab, form feed).
WHITESPACE = " \t\n\r\x0b\x0c"

# The end of a whole number written with a fraction of zeros only.
ZERO_FRACTION = "[.]0*"


def _sql_string(text: str) -> str:
    out = []
    for ch in text:
        if ch in "\\'":
            out.append("\\" + ch)
        elif ord(ch) < 32:
            out.append(f"\\u{ord(ch):04x}")
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def quote_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def load_rule_sql(name: str, data_type: T.DataType, length: int | None = None) -> str:
    """The load rules of one column as a SQL expression, aliased to ``name``.

    ``try_cast`` keeps the behaviour independent of the session's ANSI setting
    and gives NULL for a blank cell; the further test runs only on the rare
    cells whose cast failed (``coalesce`` stops at the first value).
    """
    c = quote_name(name)
    white = _sql_string(WHITESPACE)
    blank = f"length(trim(BOTH {white} FROM {c})) = 0"
    if isinstance(data_type, T.StringType):
        kept = f"CASE WHEN {blank} THEN NULL ELSE {c} END"
        body = kept if length is None else f"left({kept}, {int(length)})"
        return f"{body} AS {c}"
    t = data_type.simpleString()
    typed = f"try_cast({c} AS {t})"
    if isinstance(data_type, T.IntegralType):
        # Cut before the one cast: a cast that fails costs several times one that succeeds.
        end = _sql_string(f"{ZERO_FRACTION}[{WHITESPACE}]*$")
        typed = (f"try_cast(CASE WHEN contains({c}, '.') THEN regexp_replace({c}, {end}, '') "
                 f"ELSE {c} END AS {t})")
    said = ", ".join([_sql_string(f"cannot load column {name} as {t}: '"), c, _sql_string("'")])
    message = f"reduce(array({said}), '', (text, part) -> text || part)"
    return (f"coalesce({typed}, CASE WHEN NOT ({blank}) "
            f"THEN CAST(raise_error({message}) AS {t}) END) AS {c}")
