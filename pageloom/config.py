"""Settings of a run: defaults, then a file, then flags."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields

RESERVED = {"model", "messages", "response_format", "stream", "n", "max_tokens", "max_completion_tokens"}
PROVIDERS = {"openai": ("https://api.openai.com/v1", "OPENAI_API_KEY"), "openrouter": ("https://openrouter.ai/api/v1", "OPENROUTER_API_KEY")}


class ConfigError(ValueError):
    """Settings that contradict their rules; exit code 2."""


@dataclass(frozen=True)
class Config:
    provider: str
    model: str
    postprocess_model: str | None = None
    base_url: str | None = None
    max_pages: int | None = None
    image_max_side: int | None = 2048
    image_format: str = "jpeg"
    image_detail: str = "auto"
    request_timeout_s: float = 180.0
    max_retries: int = 3
    max_output_tokens: int | None = 4000
    use_context: bool = True
    context_recent_scans: int = 5
    context_max_chars: int = 2000
    ocr_format: str = "auto"
    ocr_max_chars: int = 6000
    reconcile_max_chars: int = 100_000
    reconcile_max_output_tokens: int | None = 16_000
    request_params: dict = field(default_factory=dict)

    def __post_init__(self):
        bad = [n for n, lo, hi in (("max_pages", 1, None), ("image_max_side", 256, None), ("max_retries", 0, 10), ("max_output_tokens", 1, None), ("context_recent_scans", 0, 50), ("context_max_chars", 200, None), ("ocr_max_chars", 200, None), ("reconcile_max_chars", 1000, None), ("reconcile_max_output_tokens", 1, None)) if (v := getattr(self, n)) is not None and (v < lo or (hi is not None and v > hi))]
        bad += [n for n, allowed in (("provider", PROVIDERS), ("image_format", ("jpeg", "png")), ("image_detail", ("auto", "low", "high")), ("ocr_format", ("auto", "txt", "alto"))) if getattr(self, n) not in allowed]
        bad += ["model"] * (not self.model) + ["request_timeout_s"] * (self.request_timeout_s <= 0)
        bad += ["base_url"] * (self.base_url is not None and not self.base_url.startswith(("http://", "https://")))
        bad += [f"request_params.{k}" for k in sorted(RESERVED & set(self.request_params))]
        if "provider" in self.request_params and not (self.provider == "openrouter" and isinstance(self.request_params["provider"], dict)):
            bad.append("request_params.provider")
        if bad:
            raise ConfigError(f"bad settings: {', '.join(bad)}")

    @property
    def url(self) -> str:
        return self.base_url or PROVIDERS[self.provider][0]

    def api_key(self) -> str:
        """From the environment alone; never stored, never put into a DataFrame."""
        name = PROVIDERS[self.provider][1]
        if not os.environ.get(name):
            raise ConfigError(f"{name} is not set")
        return os.environ[name]

    def identity(self) -> dict[str, str]:
        """Settings that a resumed run must share, as text; those of the context only where it is used."""
        names = ["provider", "model", "url", "image_max_side", "image_format", "image_detail", "max_output_tokens", "use_context", "ocr_format", "ocr_max_chars", "request_params"]
        names += ["context_recent_scans", "context_max_chars"] if self.use_context else []
        return {n: json.dumps(getattr(self, n), sort_keys=True) for n in names}


def read_settings(path: str) -> dict:
    """The settings of a JSON file; ConfigError if it is missing, unreadable or no JSON object."""
    try:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
    except FileNotFoundError:
        raise ConfigError(f"no settings at {path}") from None
    except (OSError, ValueError) as exc:  # broken JSON and broken UTF-8 are both ValueErrors
        raise ConfigError(f"cannot read settings from {path}: {exc}") from None
    if not isinstance(found, dict):
        raise ConfigError(f"{path} holds no JSON object")
    return found


def build_config(file: dict | None = None, flags: dict | None = None) -> Config:
    """Flags win over the file; another provider on the command line drops the file's base_url. Unknown keys are errors."""
    file, flags = dict(file or {}), {k: v for k, v in (flags or {}).items() if v is not None}
    if flags.get("provider", file.get("provider")) != file.get("provider"):
        file.pop("base_url", None)
    given = file | flags
    if "api_key" in given:
        raise ConfigError(f"keys belong into the environment ({', '.join(key for _, key in PROVIDERS.values())}), not into settings")
    unknown = sorted(set(given) - {f.name for f in fields(Config)})
    if unknown:
        raise ConfigError(f"unknown settings: {', '.join(unknown)}")
    missing = [n for n in ("provider", "model") if n not in given]
    if missing:
        raise ConfigError(f"missing settings: {', '.join(missing)}")
    return Config(**given)


def check_paths(output: str, *inputs: str) -> None:
    """The output must not lie inside an input folder."""
    out = os.path.abspath(output)
    for p in inputs:
        if os.path.commonpath([os.path.abspath(p), out]) == os.path.abspath(p):
            raise ConfigError(f"output {output} is inside {p}")
