"""Settings as a tree: deep update, delete, leaves, command-line words."""

from __future__ import annotations

import copy
import json
import os
from collections.abc import Iterator
from typing import Any


class ConfigTree:
    """A nested dict with defaults; files are YAML where that is installed, else JSON (which YAML reads)."""

    def __init__(self, data: dict[str, Any] | None = None, defaults: dict[str, Any] | None = None) -> None:
        self.data = copy.deepcopy(defaults or {})
        self.update(data or {})

    @classmethod
    def load(cls, path: str, defaults: dict[str, Any] | None = None) -> ConfigTree:
        if not os.path.exists(path):
            return cls(defaults=defaults)
        with open(path, encoding="utf-8") as f:
            text = f.read()
        try:
            import yaml
        except ImportError:
            return cls(json.loads(text or "{}"), defaults)
        return cls(yaml.safe_load(text) or {}, defaults)

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            try:
                import yaml
            except ImportError:
                json.dump(self.data, f, indent=2)
            else:
                yaml.safe_dump(self.data, f, sort_keys=False)

    def update(self, new: dict[str, Any]) -> ConfigTree:
        """Merges nested dicts; any other value replaces what stood there."""
        stack = [(self.data, new)]
        while stack:
            old, part = stack.pop()
            for key, value in part.items():
                if isinstance(value, dict) and isinstance(old.get(key), dict):
                    stack.append((old[key], value))
                else:
                    old[key] = copy.deepcopy(value)
        return self

    def delete(self, key: str) -> bool:
        """Removes the key wherever it stands; whether it stood anywhere."""
        found, stack = False, [self.data]
        while stack:
            d = stack.pop()
            if key in d:
                del d[key]
                found = True
            stack += [v for v in d.values() if isinstance(v, dict)]
        return found

    def leaves(self, data: dict[str, Any] | None = None) -> Iterator[tuple[str, Any]]:
        for key, value in (self.data if data is None else data).items():
            if isinstance(value, dict):
                yield from self.leaves(value)
            else:
                yield key, value

    def words(self, prefix: str = "--") -> list[str]:
        """True gives the bare option, False and None nothing, a list the option and its items, else one word ``--key value``."""
        out: list[str] = []
        for key, value in self.leaves():
            option = f"{prefix}{key}"
            if value is True:
                out.append(option)
            elif isinstance(value, list):
                out += [option, *map(str, value)]
            elif value is not None and value is not False:
                out.append(f"{option} {value}")
        return out
