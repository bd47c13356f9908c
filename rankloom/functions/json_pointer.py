"""JSON pointers over string columns holding JSON documents."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote_plus

from pyspark.sql import Column
from pyspark.sql import functions as F


def pointer_tokens(pointer: str) -> list[str]:
    """Steps of a pointer such as ``/a/0/b`` or its URL-encoded form ``#/a/0/b``."""
    if pointer in ("", "#"):
        return []
    if pointer.startswith("#/"):
        steps = unquote_plus(pointer[2:])
    elif pointer.startswith("/"):
        steps = pointer[1:]
    else:
        raise ValueError("a JSON pointer starts with '/' or '#/'")
    return [step.replace("~1", "/").replace("~0", "~") for step in steps.split("/")]


def _step(value: Column, token: str) -> Column:
    """What ``token`` leads to from a JSON text: a member, or an element where the text is an array."""
    member = F.try_element_at(F.from_json(value, "map<string,string>"), F.lit(token))
    if not (token == "0" or token.isdecimal() and token.isascii() and token[0] != "0" and len(token) < 10):
        return member
    return F.coalesce(F.get(F.from_json(value, "array<string>"), F.lit(int(token))), member)


def _stepper(token: str) -> Callable[[Column], Column]:
    return lambda text: _step(text, token)


def json_pointer(document: Column, pointer: str) -> Column:
    """Value a pointer leads to, as text; NULL where there is none. Any member name may be a step."""
    value = document
    for token in pointer_tokens(pointer):
        # Bound by a lambda, so that a step that looks twice doesn't double all before it.
        value = F.get(F.transform(F.array(value), _stepper(token)), F.lit(0))
    return value
