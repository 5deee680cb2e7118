"""Configuration: a table of known keys with kinds and ranges; unknown, repeated or out-of-range values are errors."""

from __future__ import annotations

import math
import os
import re
from dataclasses import dataclass
from urllib.parse import urlsplit

MOST_BYTES = 256 << 10


class ConfigError(ValueError):
    """A configuration that can't be used."""


@dataclass(frozen=True)
class Key:
    """One setting: its kind (str, bool, int, float, path or list), default, range and choices."""

    kind: str
    default: object = None
    least: float | None = None
    most: float | None = None
    choices: tuple[str, ...] = ()


# The settings, their defaults and ranges.
KEYS: dict[str, dict[str, Key]] = {
    "output": {"directory": Key("path", "./output"), "subdirectory_per_pptx": Key("bool", True), "naming": Key("str", "stem", choices=("stem", "stem_hash")), "allow_existing": Key("bool", False)},
    "render": {
        "backend": Key("str", "powerpoint", choices=("auto", "powerpoint", "libreoffice")), "dpi": Key("int", 300, 72, 600), "source_padding_ratio": Key("float", 0.002, 0.0, 0.1), "model_padding_px": Key("int", 24, 0, 512),
        "block_external_resources": Key("bool", True), "rendered_slides_dir": Key("path"), "office_binary": Key("str"), "pdf_binary": Key("str"),
    },
    "extraction": {"include_images": Key("bool", False), "include_empty_shapes": Key("bool", False), "strict": Key("bool", False)},
    "vlm_api": {"base_url": Key("str", ""), "model": Key("str", ""), "api_key": Key("str", ""), "api_key_env": Key("str", ""), "timeout_seconds": Key("float", 180.0, 1.0, 86400.0), "max_tokens": Key("int", 8192, 1, 1_000_000)},
    "llm_api": {"base_url": Key("str", ""), "model": Key("str", ""), "api_key": Key("str", ""), "api_key_env": Key("str", ""), "timeout_seconds": Key("float", 180.0, 1.0, 86400.0), "max_tokens": Key("int", 4096, 1, 1_000_000)},
    "ocr": {"policy": Key("str", "auto", choices=("auto", "never", "always")), "backend": Key("str", "none"), "timeout_seconds": Key("float", 600.0, 1.0, 86400.0), "argv": Key("list", ())},
    "semantic": {"policy": Key("str", "selected", choices=("selected", "complete")), "max_topics": Key("int", 64, 1, 10_000), "prompt_chars": Key("int", 36_000, 512, 10_000_000), "repairs": Key("int", 2, 0, 10)},
    "wiki": {"title": Key("str", "Evidence"), "max_entities": Key("int", 256, 1, 100_000), "max_relationships": Key("int", 512, 1, 1_000_000)},
    "network": {"allow_remote": Key("bool", False), "allow_http": Key("bool", False)},
}
VERSIONS = (1, 2)


def checked(value: object, key: Key, name: str, base: str = ".") -> object:
    """A value of the key's kind within its range; text may hold ${NAME} of the environment."""
    if value is None:
        return key.default
    if key.kind == "bool":
        if not isinstance(value, bool):
            raise ConfigError(f"{name} must be true or false")
        return value
    if key.kind in ("int", "float"):
        if isinstance(value, bool) or not isinstance(value, int if key.kind == "int" else (int, float)):
            raise ConfigError(f"{name} must be a number")
        if not math.isfinite(value) or not (key.least if key.least is not None else -math.inf) <= value <= (key.most if key.most is not None else math.inf):
            raise ConfigError(f"{name} must lie between {key.least} and {key.most}")
        return value
    if key.kind == "list":
        if not isinstance(value, (list, tuple)) or not all(isinstance(x, str) for x in value):
            raise ConfigError(f"{name} must be a list of texts")
        return tuple(value)
    if not isinstance(value, str):
        raise ConfigError(f"{name} must be text")
    value = re.sub(r"\$\{(\w+)\}", lambda m: os.environ.get(m[1], ""), value)
    if key.choices and value not in key.choices:
        raise ConfigError(f"{name} must be one of {', '.join(key.choices)}")
    return os.path.normpath(os.path.join(base, os.path.expanduser(value))) if key.kind == "path" else value


def parsed(root: dict, base: str = ".") -> dict[str, dict[str, object]]:
    """Settings of every section from nested mappings."""
    if not isinstance(root, dict):
        raise ConfigError("the configuration must be a mapping")
    root = dict(root)
    version = root.pop("version", 1)
    if version not in VERSIONS:
        raise ConfigError(f"unsupported version: {version!r}")
    known = set(KEYS) - ({"semantic"} if version == 1 else set())
    if extra := set(root) - known:
        raise ConfigError(f"unknown sections: {', '.join(sorted(map(str, extra)))}")
    out = {}
    for section, keys in KEYS.items():
        own = root.get(section) or {}
        if not isinstance(own, dict) or set(own) - set(keys):
            raise ConfigError(f"unknown keys in {section}")
        out[section] = {k: checked(own.get(k), spec, f"{section}.{k}", base) for k, spec in keys.items()}
    for section in ("vlm_api", "llm_api"):
        if out[section]["base_url"]:
            endpoint(str(out[section]["base_url"]), section, bool(out["network"]["allow_remote"]), bool(out["network"]["allow_http"]))
    return out


def endpoint(url: str, name: str, remote: bool = False, plain: bool = False) -> None:
    """http or https without credentials, query or fragment; the local host unless `remote`, https unless local or `plain`."""
    parts = urlsplit(url)
    if parts.scheme not in ("http", "https") or not parts.hostname or parts.username or parts.query or parts.fragment:
        raise ConfigError(f"{name} is no plain http address")
    local = parts.hostname in ("localhost", "::1") or parts.hostname.startswith("127.")
    if not local and not remote:
        raise ConfigError(f"{name} is remote")
    if not local and parts.scheme == "http" and not plain:
        raise ConfigError(f"{name} is not encrypted")


def loaded(path: str) -> dict[str, dict[str, object]]:
    """Settings from a YAML file without anchors, aliases, merges or repeated keys."""
    import yaml

    class Strict(yaml.SafeLoader):
        def construct_mapping(self, node, deep=False):
            keys = [self.construct_object(k, deep=True) for k, _ in node.value]
            if len(set(keys)) < len(keys):
                raise ConfigError(f"repeated keys at line {node.start_mark.line + 1}")
            return super().construct_mapping(node, deep)

    with open(path, encoding="utf-8-sig") as f:
        text = f.read(MOST_BYTES + 1)
    if len(text.encode()) > MOST_BYTES:
        raise ConfigError("the file is too large")
    if any(isinstance(t, (yaml.AnchorToken, yaml.AliasToken)) or isinstance(t, yaml.ScalarToken) and t.plain and t.value == "<<" for t in yaml.scan(text)):
        raise ConfigError("anchors, aliases and merges are not allowed")
    return parsed(yaml.load(text, Strict) or {}, os.path.dirname(os.path.abspath(path)))


def secret(section: dict[str, object]) -> str | None:
    """The key itself, or what the environment has under its name."""
    return section["api_key"] or (os.environ.get(str(section["api_key_env"])) if section["api_key_env"] else None) or None


def local_device(value: str) -> str:
    """cpu, gpu or gpu:N, in lower case."""
    value = value.strip().lower().replace("cuda", "gpu")
    if not re.fullmatch(r"cpu|gpu(:\d{1,2})?", value):
        raise ConfigError(f"unknown device: {value!r}")
    return value
