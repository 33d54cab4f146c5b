"""Column expressions shared by the operators. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A user counts as online for this long after the last action.
ONLINE_WINDOW_MS = 300_000

# Characters of "/wall?username=" in a wall address.
WALL_PREFIX_LENGTH = 15


def capitalise(text: Column) -> Column:
    """Lower-case everything, then raise the first letter (not one per word)."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(text.substr(F.lit(2), F.length(text))))


def token(text: Column, position: int) -> Column:
    """The token at ``position`` (from 1) of a text split on single spaces, or the empty string."""
    return F.coalesce(F.get(F.split(text, " "), F.lit(position - 1)), F.lit(""))


def post_key(author: Column, timestamp: Column) -> Column:
    """Key under which the comments of a post are stored."""
    return F.concat_ws("$", author, timestamp.cast("string"))


def affiliation_post(affiliation: Column) -> Column:
    return F.concat(F.lit("I changed my affiliation to "), affiliation, F.lit("!"))


def interests_post(interests: Column) -> Column:
    """Sentence for a changed interest list; the comma also stands before "and" with two."""
    last = F.element_at(interests, -1)
    lead = F.array_join(F.transform(F.slice(interests, F.lit(1), F.size(interests) - 1),
                                    lambda x: F.concat(x, F.lit(", "))), "")
    return F.concat(F.lit("I am now interested in "), lead, F.lit("and "), last, F.lit("!"))


def password_hash(password: Column) -> Column:
    return F.sha2(password, 256)


def display_date(timestamp_ms: Column) -> Column:
    """Epoch milliseconds as shown on a page, such as ``Dec 21 2021 03:30`` (UTC)."""
    return F.date_format(F.timestamp_millis(timestamp_ms), "MMM dd yyyy HH:mm")


def wall_owner(address: Column) -> Column:
    """User name in a wall address."""
    return address.substr(F.lit(WALL_PREFIX_LENGTH + 1), F.length(address))


def chat_line(author: Column, message: Column) -> Column:
    return F.concat(F.lit("("), author, F.lit(") :"), message)


def is_online(last_action: Column, now_ms: Column, window_ms: int = ONLINE_WINDOW_MS) -> Column:
    """True within the window, ends included; no known action means offline."""
    return F.coalesce(now_ms - last_action <= window_ms, F.lit(False))


def room_id(participants: Column, typed_by: Column) -> Column:
    """Room of a comma-separated list of users and the user who typed it: sorted, joined by comma."""
    return F.array_join(F.array_sort(F.array_append(F.split(participants, ","), typed_by)), ",")


def quantise(weight: Column) -> Column:
    """Weight as an integer of millionths.

    The offset keeps dyadic weights off the rounding ties, so two engines that
    add in different order still agree.
    """
    return F.floor(weight * 1e6 + 0.3719).cast("bigint")


def by_weight(weight: Column) -> Column:
    """What to rank a weight by: twelve significant digits, as (exponent, digits).

    Sums that differ only by the order of adding are equal, however small they are.
    """
    exponent = F.floor(F.log10(weight))
    return F.struct(exponent.alias("exponent"), F.round(weight * F.pow(F.lit(10.0), 11 - exponent)).alias("digits"))
