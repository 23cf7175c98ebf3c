"""Lists, days, tokens and messages as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Labels of the days, as the subject and as the time ("on ...").
DAYS = {
    "Monday": ("Понедельник", "понедельник"),
    "Tuesday": ("Вторник", "вторник"),
    "Wednesday": ("Среда", "среду"),
    "Thursday": ("Четверг", "четверг"),
    "Friday": ("Пятница", "пятницу"),
    "Saturday": ("Суббота", "субботу"),
    "Sunday": ("Воскресенье", "воскресенье"),
}
UNKNOWN_MARK = "❌"


def list_of(x: Column) -> Column:
    """``['a', 'b']`` to an array, by white space once brackets, quotes and commas are gone; a name with a blank becomes two."""
    bare = F.replace(F.replace(F.btrim(x, F.lit("[]")), F.lit("'"), F.lit("")), F.lit(","), F.lit(""))
    return F.filter(F.split(bare, r"\s+"), lambda t: t != "")


def quoted_list_of(x: Column) -> Column:
    """The same by quotes, which keeps names with blanks, and reads double quotes too."""
    return F.transform(F.regexp_extract_all(x, F.lit(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")"""), F.lit(1)), lambda t: F.substring(t, F.lit(2), F.length(t) - 2))


def item(xs: Column, i: int) -> Column:
    """Of an array, or null."""
    return F.get(xs, F.lit(i))


def first_side(xs: Column, n: int = 5, skip: int = 5) -> Column:
    """The n names after the first ``skip``; null of fewer than both together."""
    return F.when(F.size(xs) >= n + skip, F.slice(xs, skip + 1, n))


def second_side(xs: Column, n: int = 5, skip: int = 5) -> Column:
    """The last n names, last first."""
    return F.when(F.size(xs) >= n + skip, F.reverse(F.slice(xs, -n, n)))


def halves(xs: Column, n: int = 5) -> tuple[Column, Column]:
    """The first n names and whatever is left."""
    rest = F.when(F.size(xs) > n, F.slice(xs, F.lit(n + 1), F.greatest(F.size(xs), F.lit(1)))).otherwise(F.slice(xs, 1, 0))
    return F.slice(xs, 1, n), rest


def leading_word(x: Column) -> Column:
    return F.regexp_extract(x, r"(?U)^(\w+)", 1)


def weekday(x: Column) -> Column:
    return F.date_format(x, "EEEE")


def day_label(day: Column, accusative: bool = False) -> Column:
    table = F.create_map(*(F.lit(v) for k, names in DAYS.items() for v in (k, names[int(accusative)])))
    return F.element_at(table, day)


def millis(x: Column, tz: str = "UTC") -> Column:
    """A moment given in thousandths of seconds, as the time of a zone."""
    return F.from_utc_timestamp(F.timestamp_millis(x.cast("bigint")), tz)


def seconds(x: Column, tz: str = "UTC") -> Column:
    return F.from_utc_timestamp(F.timestamp_seconds(x.cast("bigint")), tz)


def clock(x: Column) -> Column:
    return F.date_format(x, "HH:mm")


def days_since(date: Column, origin: Column | str) -> Column:
    """Whole days; negative before the origin."""
    return F.datediff(date, F.lit(origin).cast("date") if isinstance(origin, str) else origin)


def call(i: Column, day: Column) -> Column:
    """Token of a match of a list."""
    return F.concat(F.lit("m"), i.cast("string"), F.lit("%"), day.cast("string"))


def call_parts(token: Column) -> tuple[Column, Column, Column]:
    """Kind (match, update or other), place and day of a token; place and day are null where there is none."""
    kind = F.when(F.startswith(token, F.lit("m")), F.lit("match")).when(F.startswith(token, F.lit("update")), F.lit("update")).otherwise(F.lit("other"))
    place = F.when(kind == "match", F.regexp_extract(token, r"^m(\d+)", 1).try_cast("bigint"))
    day = F.when(kind == "update", F.regexp_extract(token, r"^update(\w+)", 1)).when(kind == "match", F.regexp_extract(token, r"%(\w+)", 1))
    return kind, place, F.when(day != "", day)


def marked(label: Column, unknown: Column) -> Column:
    return F.when(unknown, F.concat(F.lit(UNKNOWN_MARK), label)).otherwise(label)
