"""Settings from the environment, else from an env file; secrets don't show."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

PREFIX = "PRICEQUARRY_"
# The billing codes that are extracted, and their type.
CODES, CODE_TYPE = ("90837", "90834", "90832"), "CPT"
SECRET = ("key", "secret", "token", "password")


def read_env_file(path: str) -> dict[str, str]:
    """NAME=value lines; comments and blank lines are passed over, surrounding quotes dropped."""
    out = {}
    if os.path.exists(path):
        with open(path) as f:
            for line in f:
                name, eq, value = line.strip().partition("=")
                if eq and not name.startswith("#"):
                    out[name.strip()] = value.strip().strip("\"'")
    return out


@dataclass(frozen=True, repr=False)
class Settings:
    data_dir: str = "data"
    store_dir: str = "store"
    cache_dir: str = "cache"
    store_secret: str = ""
    keep_dates: int = 2
    state: str = ""
    state_marker: str = ""

    @classmethod
    def load(cls, env_file: str = ".env", environ: Mapping[str, str] | None = None) -> Settings:
        given = read_env_file(env_file) | dict(os.environ if environ is None else environ)
        values = {f.name: given[PREFIX + f.name.upper()] for f in fields(cls) if PREFIX + f.name.upper() in given}
        return cls(**{k: int(v) if k == "keep_dates" else v for k, v in values.items()})

    @classmethod
    def from_mapping(cls, given: Mapping[str, object], required: tuple[str, ...] = ()) -> Settings:
        """Of a config file; unknown and missing names are errors."""
        names = {f.name for f in fields(cls)}
        if wrong := sorted(set(given) - names) + sorted(set(required) - set(given)):
            raise ValueError(f"unknown or missing settings: {wrong}")
        return cls(**given)

    def __repr__(self) -> str:
        shown = [f"{f.name}={'***' if any(s in f.name for s in SECRET) and getattr(self, f.name) else getattr(self, f.name)!r}" for f in fields(self)]
        return f"Settings({', '.join(shown)})"
