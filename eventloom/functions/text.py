"""Message templates, rendering and text repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.schema import AUTO, AUTO_KEY, EMPTY_MESSAGE, PLACEHOLDER, USER, USER_KEY

# A variable is a run of these characters holding at least one digit. The look-behind lets a match
# begin only where a run begins, which keeps long digit-free runs linear.
_RUN = "A-Za-z0-9_./-"
VARIABLE = rf"(?<![{_RUN}])[A-Za-z_./-]*+[0-9][{_RUN}]*+"


def repair_utf8(raw: Column) -> Column:
    """Bytes as text, with U+FFFD in place of invalid sequences."""
    return F.make_valid_utf8(raw.cast("string"))


def template_of(message: Column) -> Column:
    """A message with every variable replaced by a placeholder.

    A message that already holds the placeholder character is kept whole, see variables_of.
    """
    return F.when(message.contains(PLACEHOLDER), message).otherwise(
        F.regexp_replace(message, VARIABLE, PLACEHOLDER)
    )


def variables_of(message: Column) -> Column:
    """A message's variables in order; null for messages kept whole as their own template."""
    return F.when(
        ~message.contains(PLACEHOLDER), F.regexp_extract_all(message, F.lit(VARIABLE), F.lit(0))
    )


def render_unstructured(logtype: Column, variables: Column) -> Column:
    """Template plus variables back to the message; an error if their numbers do not fit."""
    fixed = F.split(logtype, PLACEHOLDER, -1)
    woven = F.array_join(
        F.zip_with(fixed, variables, lambda text, var: F.concat(text, F.coalesce(var, F.lit("")))),
        "",
    )
    return (
        F.when(variables.isNull(), logtype)
        .when(F.size(fixed) == F.size(variables) + 1, woven)
        .otherwise(F.raise_error(F.concat(F.lit("cannot decode message: "), logtype)))
    )


def render_structured(auto_kv: Column | None = None, user_kv: Column | None = None) -> Column:
    """Both namespaces as one compact JSON text; '{}' if either cannot be rendered."""
    auto_kv = F.col(AUTO) if auto_kv is None else auto_kv
    user_kv = F.col(USER) if user_kv is None else user_kv
    text = F.concat(
        F.lit('{"%s":' % AUTO_KEY),
        F.to_json(auto_kv),
        F.lit(',"%s":' % USER_KEY),
        F.to_json(user_kv),
        F.lit("}"),
    )
    return F.coalesce(text, F.lit(EMPTY_MESSAGE))
