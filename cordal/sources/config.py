"""Operator configuration from TOML and the secret of the keys."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Config:
    """Settings of a run; unset ones keep their defaults."""

    entrada: str | None = None
    salida: str | None = None
    extensiones: tuple[str, ...] = ("pdf",)
    tope_bytes: int = 50 * 1024 * 1024
    ventana_dias: int = 7
    particiones: int | None = None


_SECRET_WORDS = ("pepper", "secret", "clave", "password", "token")


def load_config(path: str | None = None, variable: str = "CORDAL_CONFIG") -> Config:
    """Explicit path, else the environment variable, else ``cordal.toml`` here.

    Unknown keys are errors; keys that look like secrets are refused by name.
    """
    chosen = path or os.environ.get(variable) or ("cordal.toml" if Path("cordal.toml").exists() else None)
    if chosen is None:
        return Config()
    with open(chosen, "rb") as source:
        values = tomllib.load(source)
    known = {f.name for f in fields(Config)}
    for key in values:
        if any(w in key.lower() for w in _SECRET_WORDS):
            raise ValueError(f"{key}: secrets do not belong into the configuration file")
        if key not in known:
            raise ValueError(f"unknown setting: {key}")
    for key in ("tope_bytes", "ventana_dias", "particiones"):
        if key in values and (isinstance(values[key], bool) or not isinstance(values[key], int)):
            raise ValueError(f"{key} must be an integer")
    if "extensiones" in values:
        values["extensiones"] = tuple(str(x) for x in values["extensiones"])
    return Config(**values)


def load_secret(variable: str = "CORDAL_SECRET", file_variable: str = "CORDAL_SECRET_FILE") -> bytes:
    """Environment variable, else the file it names; absence is fatal, the value is never shown."""
    if value := os.environ.get(variable):
        return value.encode()
    if name := os.environ.get(file_variable):
        value = Path(name).read_bytes().strip()
        if value:
            return value
    raise RuntimeError(f"no secret: set {variable} or {file_variable}")


def doctor(config: Config) -> list[tuple[str, bool, str]]:
    """All checks at once: (name, passed, advice)."""
    found = []
    try:
        load_secret()
        found.append(("secret", True, ""))
    except (RuntimeError, OSError) as error:
        found.append(("secret", False, str(error) if isinstance(error, RuntimeError) else "secret file cannot be read"))
    folder = config.entrada
    ok = bool(folder) and ("://" in folder or Path(folder).is_dir())
    found.append(("input folder", ok, "" if ok else "set entrada to an existing folder"))
    return found
