"""Words as the contracts define them, and rows that are out of the ordinary."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
A = "one two three four five six seven eight nine ten eleven twelve"


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda found: found[0].lower(), text)


def alphanumeric(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def spaced(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


ROWS = [
    (1, A + ".\nA line that three documents share, somewhere.\nend", "en", "a", 10),
    (2, "  a LINE that three documents share, somewhere.\t\n" + A, "en", None, None),
    (3, "A line that three documents share, somewhere.", None, "b", 3),
    (4, None, "en", "a", None),
    (5, "", "de", "b", 0),
    (None, "A line that three documents share, somewhere.\nno id", "en", "a", 5),
    (7, " \n\t\n", "en", "", 4),
    (8, "grüße aus köln: " * 4000, "de", "a", 64000),
    (9, A, "en", "a", 60),
    (9, A, "en", "a", 60),
    (10, "x", "en", "b", 1),
]
