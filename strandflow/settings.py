"""Settings: nested dictionaries with ``${NAME}`` references to each other's top-level values and the environment."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from typing import Any

_REF = re.compile(r"\$\{(\w+)\}")


def expand(values: Mapping[str, Any], env: Mapping[str, str] | None = None) -> dict[str, Any]:
    """All strings with their references replaced; unknown names stay as they are, and a circle raises ValueError."""
    env = os.environ if env is None else env

    def resolve(x: Any, open_: tuple[str, ...]) -> Any:
        if isinstance(x, Mapping):
            return {k: resolve(v, open_) for k, v in x.items()}
        if isinstance(x, (list, tuple)):
            return [resolve(v, open_) for v in x]
        if not isinstance(x, str):
            return x

        def value(m: re.Match) -> str:
            name = m[1]
            if name in open_:
                raise ValueError(f"{name} refers to itself")
            if isinstance(values.get(name), str):
                return resolve(values[name], (*open_, name))
            return env.get(name, m[0])

        return _REF.sub(value, x)

    return {k: resolve(v, (k,)) for k, v in values.items()}
