"""Configuration and logging of the driver."""

from __future__ import annotations

import logging
import os
from pathlib import Path
from typing import Any

ROOT = Path(__file__).resolve().parent.parent


class ConfigError(RuntimeError):
    """The configuration can't be read."""


def load_config(path: str | Path | None = None) -> dict[str, Any]:
    """The mapping in a YAML file: the given one, the one that TALLOW_CONFIG names, or config/config.yaml."""
    import yaml

    found = Path(path or os.environ.get("TALLOW_CONFIG") or ROOT / "config" / "config.yaml")
    if not found.is_file():
        raise ConfigError(f"no configuration file at {found}")
    try:
        config = yaml.safe_load(found.read_text(encoding="utf-8"))
    except yaml.YAMLError as e:
        raise ConfigError(f"{found} is not valid YAML") from e
    if not isinstance(config, dict):
        raise ConfigError(f"{found} holds no mapping at its top")
    return config


def config_value(config: dict[str, Any], path: str, default: Any = None) -> Any:
    """The value under a dotted path, or the default where a step is missing."""
    for step in path.split("."):
        if not isinstance(config, dict) or step not in config:
            return default
        config = config[step]
    return config


def project_path(path: str | Path) -> Path:
    """The path itself if absolute, else below the project's folder; ~ is the user's home."""
    return ROOT / Path(path).expanduser()


def ensure_directories(config: dict[str, Any]) -> list[Path]:
    """Makes the local folders named under ``paths`` (lake folders need none: Spark's writer makes them)."""
    made = [project_path(v) for k in ("raw", "curated", "features", "outputs", "logs") if (v := config_value(config, f"paths.{k}"))]
    for p in made:
        p.mkdir(parents=True, exist_ok=True)
    return made


def setup_logging(config: dict[str, Any] | None = None) -> logging.Logger:
    """The package's logger, given its handlers once."""
    logger = logging.getLogger("tallow")
    if logger.handlers:
        return logger
    config = config or {}
    logger.setLevel(getattr(logging, str(config_value(config, "logging.level", "INFO")).upper(), logging.INFO))
    handlers: list[logging.Handler] = []
    if config_value(config, "logging.console", True):
        handlers.append(logging.StreamHandler())
    if config_value(config, "logging.file", False):
        target = project_path(config_value(config, "logging.log_file", "logs/tallow.log"))
        target.parent.mkdir(parents=True, exist_ok=True)
        handlers.append(logging.FileHandler(target, encoding="utf-8"))
    form = logging.Formatter(config_value(config, "logging.format", "%(asctime)s %(levelname)s %(name)s: %(message)s"))
    for h in handlers or [logging.NullHandler()]:
        h.setFormatter(form)
        logger.addHandler(h)
    return logger


def get_logger(name: str) -> logging.Logger:
    setup_logging()
    return logging.getLogger(f"tallow.{name}")
