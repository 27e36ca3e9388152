"""Paths, names and formatted text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def extension(path: Column) -> Column:
    return F.regexp_extract(basename(path), r".(\.[^.]*)$", 1)


def is_image(path: Column) -> Column:
    return F.lower(path).rlike(r"\.(png|jpe?g)$")


def underscore(word: Column) -> Column:
    """CamelCase and dashes to snake_case."""
    out = F.regexp_replace(F.regexp_replace(word, r"([A-Z]+)([A-Z][a-z])", "$1_$2"), r"([a-z\d])([A-Z])", "$1_$2")
    return F.lower(F.replace(out, F.lit("-"), F.lit("_")))


def loss_label(kind: Column, net: str) -> Column:
    return F.concat(F.lit(f"l_{net}_"), F.replace(F.lower(kind), F.lit("loss"), F.lit("")))


def human_size(n: Column) -> Column:
    """Bytes in units of 1024, written B, KB, MB and so on to YB, with one decimal (half to even is left to the formatter)."""
    out = None
    for k, unit in enumerate(("", "K", "M", "G", "T", "P", "E", "Z")):
        text = F.format_string(f"%3.1f {unit}B", n / 1024.0**k)
        out = F.when(F.abs(n) < 1024.0 ** (k + 1), text) if out is None else out.when(F.abs(n) < 1024.0 ** (k + 1), text)
    return out.otherwise(F.format_string("%3.1f YB", n / 1024.0**8))


def extra_params(entries: Column) -> Column:
    """entries: structs of key, value and text (whether the value is a text). Texts stand alone, other values as key=value, in the entries' order."""
    return F.array_join(F.transform(entries, lambda e: F.when(e["text"], e["value"]).otherwise(F.concat(e["key"], F.lit("="), e["value"]))), " ")


def scene_of(name: Column) -> Column:
    return F.substring_index(name, "_", 1)


def time_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def eta_seconds(total_seconds: Column, done: Column, last: Column) -> Column:
    return total_seconds / done * (last - done - 1)


def scalar_route(name: Column) -> Column:
    return F.when(name.startswith("l_"), F.concat(F.lit("losses/"), name)).when(name.startswith("grad_norm_"), F.concat(F.lit("grad_norms/"), name)).when(name.startswith("scale_"), F.concat(F.lit("scales/"), name)).otherwise(name)


def delta_text(seconds: Column) -> Column:
    """Whole seconds as H:MM:SS, after the days, if any."""
    s = seconds.cast("long")
    days = F.floor(s / 86400)
    clock = F.format_string("%d:%02d:%02d", F.floor(F.pmod(s, F.lit(86400)) / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))
    return F.when(days == 0, clock).otherwise(F.concat(days.cast("string"), F.when(F.abs(days) == 1, " day, ").otherwise(" days, "), clock))


def signed_clock(seconds: Column) -> Column:
    """Whole seconds as the SQL of date_eta writes those below zero: H:MM:SS of parts cut towards zero, each with its sign, minutes and seconds in two characters."""
    s = seconds.cast("long")
    two = lambda part: F.lpad(part.cast("string"), 2, "0")
    whole = lambda a, n: F.call_function("div", a, F.lit(n))
    return F.concat(whole(s % 86400, 3600).cast("string"), F.lit(":"), two(whole(s % 3600, 60)), F.lit(":"), two(s % 60))
