"""What plans say about themselves."""

from __future__ import annotations

import re


def window_keys(df) -> list[str]:
    """The partition keys of every window of a plan."""
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return [keys for line in text.splitlines() if re.search(r"\bWindow \[", line) for keys in re.findall(r"\], \[([^\]]*)\], \[[^\]]*\]\s*$", line.strip())]
