"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_password(url: Column) -> Column:
    """Replace what stands between the last ``:`` before the last ``@`` and that ``@``.

    Text without an ``@`` stays as it is.
    """
    return F.regexp_replace(url, r"(?s)^(.*):[^:]*@([^@]*)$", "$1:***@$2")
