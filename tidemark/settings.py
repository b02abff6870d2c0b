"""Settings from the environment, over those of a file `.env` in the working folder; unknown names are ignored."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    annotator_key: str = ""
    annotator_url: str = "https://api.openai.com/v1"
    model_extraction: str = "gpt-5"
    model_sentiment: str = "gpt-5"
    model_briefing: str = "gpt-5"
    http_timeout: int = 30

    @classmethod
    def read(cls, folder: str = ".", environment: dict[str, str] | None = None) -> Settings:
        """Names count in upper and lower case; a value that isn't of its field's type raises."""
        held: dict[str, str] = {}
        file = Path(folder) / ".env"
        if file.is_file():
            for line in file.read_text(encoding="utf-8").splitlines():
                name, sign, value = line.strip().partition("=")
                if sign and not name.startswith("#"):
                    held[name.strip().lower()] = value.strip().strip("'\"")
        held |= {k.lower(): v for k, v in (os.environ if environment is None else environment).items()}
        return cls(**{f.name: type(f.default)(held[f.name]) for f in fields(cls) if f.name in held})
