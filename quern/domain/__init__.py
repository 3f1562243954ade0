"""Domain packs: word lists as data files, loaded by name."""

from __future__ import annotations

import json
from importlib.resources import files


def load(name: str = "agent_banking") -> dict:
    """aspects: code -> keywords; slang: token -> replacement; markers: language -> words; keywords: relevance terms."""
    pack = json.loads(files("quern.domain").joinpath(f"{name}.json").read_text(encoding="utf-8"))
    return {
        "aspects": {k: tuple(v) for k, v in pack["aspects"].items()},
        "slang": pack["slang"],
        "markers": {k: tuple(v) for k, v in pack["markers"].items()},
        "keywords": tuple(pack["keywords"]),
    }
