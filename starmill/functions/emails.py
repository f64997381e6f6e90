"""E-mail addresses hidden in page scripts."""

from __future__ import annotations

import base64
import codecs
import html
import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions import text

ADDRESS = re.compile(text.ADDRESS, re.I)
#: marks of the classes whose tokens may carry orders (fixed values)
MARKS = ("email", "required")


def _orders(script: str) -> list[dict[str, str]]:
    """JSON objects of strings, in base64, among the class names of marked elements."""
    out = []
    for names in re.findall(r"""class\s*=\s*["']([^"']*)["']""", script):
        if any(m in names for m in MARKS):
            for token in (t for t in names.split() if 8 <= len(t) <= 80):
                try:
                    got = json.loads(base64.b64decode((token + "=" * (-len(token) % 4)).replace("-", "+").replace("_", "/"), validate=True))
                except ValueError:
                    continue
                if isinstance(got, dict) and all(isinstance(v, str) for v in got.values()):
                    out.append(got)
    return out


def decode_email(script: str | None) -> str:
    """The address of ``var a='...'`` after the script's orders: texts to remove, signs to put back, a turn by 13. Empty if that is no address."""
    found = re.search(r"""var\s+a\s*=\s*'([^']*)'""", script or "") or re.search(r'''var\s+a\s*=\s*"([^"]*)"''', script or "")
    if not found:
        return ""
    value = html.unescape(found[1]).strip().removeprefix("mailto:")
    orders = _orders(script)
    for noise in (o["rmv"] for o in orders if o.get("rmv")):
        value = value.replace(noise, "")
    value = value.translate({ord(v): k for o in orders for k, v in o.items() if len(k) == len(v) == 1})
    if any(o.get("rot") == "it" for o in orders):
        value = codecs.decode(value, "rot13")
    value = value.strip().removeprefix("mailto:").strip()
    return value if ADDRESS.fullmatch(value) else ""


@F.pandas_udf(T.StringType())
def email_column(s: pd.Series) -> pd.Series:
    return s.map(lambda x: decode_email(x) or None)
