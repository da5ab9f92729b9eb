"""Options from ``protocol::key=value;key=value;``, an environment variable or keywords."""

from __future__ import annotations

import json
import os
import ssl
import urllib.request
from dataclasses import dataclass, field, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

from lineflow.operators import delivery
from lineflow.sources.logs import Log, log

# Protocols, their default ports, known keys.
PORTS = {"http": 9000, "https": 9000, "tcp": 9009, "tcps": 9009}
KEYS = (
    "protocol_version", "addr", "username", "password", "token", "token_x", "token_y", "auto_flush", "auto_flush_rows",
    "auto_flush_interval", "request_min_throughput", "request_timeout", "retry_timeout", "init_buf_size", "max_buf_size",
    "max_name_len", "stdlib_http", "tls_verify", "tls_ca", "tls_roots", "tls_roots_password",
)
LEAST = {"auto_flush_rows": 0, "auto_flush_interval": 0, "request_min_throughput": 1, "request_timeout": 1, "retry_timeout": 0, "init_buf_size": 1, "max_buf_size": 1, "max_name_len": 1}
SETTINGS_KEY = "line.proto.support.versions"
#: The environment variable that ``from_env`` reads.
ENVIRONMENT = "LINEFLOW_CLIENT_CONF"


class ConfigError(ValueError):
    pass


@dataclass
class Options:
    protocol: str
    host: str = "localhost"
    port: int = 0
    protocol_version: str = "auto"
    username: str | None = None
    password: str | None = field(default=None, repr=False)
    token: str | None = field(default=None, repr=False)
    token_x: str | None = field(default=None, repr=False)
    token_y: str | None = field(default=None, repr=False)
    auto_flush: bool = True
    auto_flush_rows: int | None = None
    auto_flush_interval: int = delivery.FLUSH_INTERVAL_MS
    request_min_throughput: int = delivery.MIN_THROUGHPUT
    request_timeout: int = delivery.REQUEST_TIMEOUT_MS
    retry_timeout: int = delivery.RETRY_TIMEOUT_MS
    init_buf_size: int = 64 * 1024
    max_buf_size: int = 100 * 1024 * 1024
    max_name_len: int = 127
    stdlib_http: bool = False
    tls_verify: bool = True
    tls_ca: str | None = None
    log: Log = log

    def __post_init__(self) -> None:
        if not callable(self.log):
            raise ConfigError("log must be a function of a level and a message")
        if self.protocol not in PORTS:
            raise ConfigError(f"unknown protocol {self.protocol!r}, expected one of {', '.join(PORTS)}")
        self.port = self.port or PORTS[self.protocol]
        if self.protocol_version not in ("auto", "1", "2", "3"):
            raise ConfigError(f"unknown protocol version {self.protocol_version!r}")
        if self.protocol_version == "auto" and self.is_tcp:
            self.protocol_version = "1"
        if self.auto_flush_rows is None:
            self.auto_flush_rows = delivery.ROWS_TCP if self.is_tcp else delivery.ROWS_HTTP
        if self.is_tcp and (self.username or self.token or self.password) and not (self.username and self.token):
            raise ConfigError("TCP authentication needs username and token")

    @property
    def is_tcp(self) -> bool:
        return self.protocol.startswith("tcp")

    @property
    def secure(self) -> bool:
        return self.protocol in ("https", "tcps")

    def tls(self) -> ssl.SSLContext | None:
        if not self.secure:
            return None
        context = ssl.create_default_context(cafile=self.tls_ca)
        if not self.tls_verify:
            context.check_hostname, context.verify_mode = False, ssl.CERT_NONE
        return context


def split_pairs(text: str) -> list[str]:
    """Parts between single semicolons; two in a row stand for one."""
    parts, part, i = [], "", 0
    while i < len(text):
        if text[i] != ";":
            part += text[i]
        elif text[i + 1 : i + 2] == ";":
            part += ";"
            i += 1
        else:
            parts.append(part)
            part = ""
        i += 1
    return [p for p in [*parts, part] if p]


def parse_pairs(text: str) -> dict[str, str]:
    """Keys and values; the last of several values of a key holds."""
    found: dict[str, str] = {}
    for pair in split_pairs(text):
        key, equals, value = pair.partition("=")
        if not equals:
            raise ConfigError(f"no '=' in {pair!r}")
        if key not in KEYS:
            raise ConfigError(f"unknown key {key!r}")
        if not value:
            raise ConfigError(f"{key} has no value")
        if any(ord(c) < 0x20 or 0x7F <= ord(c) <= 0x9F for c in value):
            raise ConfigError(f"{key} holds a control character")
        found[key] = value
    return found


def _flag(key: str, value: str, off: str) -> bool:
    if value not in ("on", off):
        raise ConfigError(f"{key} must be on or {off}, not {value!r}")
    return value == "on"


def _integer(key: str, value: str) -> int:
    if not value.lstrip("+-").isdecimal() or not value.isascii():
        raise ConfigError(f"{key} must be an integer, not {value!r}")
    if int(value) < LEAST[key]:
        raise ConfigError(f"{key} must be at least {LEAST[key]}")
    return int(value)


def _address(value: str, protocol: str) -> tuple[str, int]:
    host, colon, port = value.partition(":")
    if not host:
        raise ConfigError("addr has no host")
    if not colon:
        return host, PORTS[protocol]
    if not (port.isascii() and port.isdecimal() and 1 <= int(port) <= 65535):
        raise ConfigError(f"invalid port {port!r}")
    return host, int(port)


def from_config(text: str, **extra: object) -> Options:
    """Options of a configuration text; ``extra`` overrides."""
    protocol, colons, rest = (text or "").partition("::")
    if not colons:
        raise ConfigError("expected protocol::key=value;")
    if protocol not in PORTS:
        raise ConfigError(f"unknown protocol {protocol!r}, expected one of {', '.join(PORTS)}")
    pairs = parse_pairs(rest)
    if "addr" not in pairs:
        raise ConfigError("addr is missing")
    for key in ("tls_roots", "tls_roots_password"):
        if key in pairs:
            raise ConfigError(f"{key} is not supported, use tls_ca")
    host, port = _address(pairs.pop("addr"), protocol)
    values: dict[str, object] = dict(pairs)
    for key, value in pairs.items():
        if key in LEAST:
            values[key] = _integer(key, value)
        elif key in ("auto_flush", "stdlib_http"):
            values[key] = _flag(key, value, "off")
        elif key == "tls_verify":
            values[key] = _flag(key, value, "unsafe_off")
    return Options(protocol, host, port, **(values | modern(extra)))


def from_env(**extra: object) -> Options:
    return from_config(os.environ.get(ENVIRONMENT, ""), **extra)


def modern(options: dict[str, object]) -> dict[str, object]:
    """Keywords without retired ones, of which the log tells."""
    out = dict(options)
    for old, new in (("copy_buffer", None), ("copyBuffer", None), ("bufferSize", "init_buf_size")):
        if old in out:
            value = out.pop(old)
            out.get("log", log)("warn", f"option {old} is not supported any more" + (f", use {new}" if new else ""))
            if new:
                out[new] = value
    if unknown := out.keys() - {f.name for f in fields(Options)}:
        raise ConfigError(f"unknown options {sorted(unknown)}")
    return out


def choose_version(settings: dict) -> str:
    """The highest version that both sides know; a server that names none knows version 1."""
    known = [str(v) for v in (settings.get("config") or {}).get(SETTINGS_KEY) or []]
    if not known:
        return "1"
    for version in ("3", "2", "1"):
        if version in known:
            return version
    raise ConfigError(f"no common protocol version among {known}")


def negotiate(options: Options) -> Options:
    """Settles version ``auto`` by the server's /settings, once on the driver."""
    if options.protocol_version == "auto":
        url = f"{options.protocol}://{options.host}:{options.port}/settings"
        with urllib.request.urlopen(url, timeout=options.request_timeout / 1000, context=options.tls()) as answer:
            options.protocol_version = choose_version(json.load(answer))
    return options


def config_pairs(text: Column) -> Column:
    """map(key, value) of configuration texts in a column, with ``;;`` as an escaped semicolon."""
    rest = F.regexp_extract(F.replace(text, F.lit(";;"), F.lit("\x00")), r"(?s)^.*?::(.*)$", 1)
    parts = F.filter(F.split(rest, ";"), lambda p: p != "")
    pair = lambda p: F.struct(
        F.regexp_extract(p, r"(?s)^([^=]*)=", 1).alias("key"), F.replace(F.regexp_extract(p, r"(?s)=(.*)$", 1), F.lit("\x00"), F.lit(";")).alias("value")
    )
    return F.map_from_entries(F.transform(parts, pair))
