"""Sending bytes: HTTP with retries, TCP.  A sender lives in one task and is not shared."""

from __future__ import annotations

import base64
import http.client
import random
import socket
import time

from lineflow.operators import delivery
from lineflow.sources.config import ConfigError, Options

TIMED_OUT = 524
#: Characters of an unexpected answer that are logged.
SHOWN = 256


class DeliveryError(RuntimeError):
    pass


class HttpSender:
    """POST /write?precision=n per batch; 204 is success.

    Answers of ``delivery.RETRYABLE`` and time-outs are tried again with doubling waits for
    ``retry_timeout`` at most; other answers and broken connections fail at once.
    """

    def __init__(self, options: Options):
        self.options = options
        self.requests = 0
        self.connection: http.client.HTTPConnection | None = None

    def _connect(self, timeout: float) -> http.client.HTTPConnection:
        o = self.options
        if self.connection is None:
            if o.secure:
                self.connection = http.client.HTTPSConnection(o.host, o.port, timeout=timeout, context=o.tls())
            else:
                self.connection = http.client.HTTPConnection(o.host, o.port, timeout=timeout)
        self.connection.timeout = timeout
        if self.connection.sock:
            self.connection.sock.settimeout(timeout)
        return self.connection

    def _headers(self) -> dict[str, str]:
        o = self.options
        if o.token:
            return {"Authorization": f"Bearer {o.token}"}
        if o.username and o.password:
            return {"Authorization": "Basic " + base64.b64encode(f"{o.username}:{o.password}".encode()).decode()}
        return {}

    def _once(self, data: bytes) -> tuple[int, str]:
        o = self.options
        limit = (len(data) / o.request_min_throughput * 1000 + o.request_timeout) / 1000
        try:
            self.requests += 1
            c = self._connect(limit)
            c.request("POST", "/write?precision=n", data, self._headers())
            answer = c.getresponse()
            return answer.status, answer.read().decode(errors="replace")
        except TimeoutError:
            self.close()
            return TIMED_OUT, "no answer in time"
        except (OSError, http.client.HTTPException) as e:
            self.close()
            raise DeliveryError(f"the connection failed: {e}") from e

    def send(self, data: bytes) -> None:
        began, wait = None, delivery.FIRST_WAIT_MS
        while True:
            status, body = self._once(data)
            if status == delivery.SUCCESS:
                if body:
                    shown = body if len(body) < SHOWN else f"{body[:SHOWN]}... ({len(body)} characters)"
                    self.options.log("warn", f"unexpected answer: {shown}")
                return
            now = time.monotonic()
            began = now if began is None else began
            if status not in delivery.RETRYABLE or (now - began) * 1000 >= self.options.retry_timeout:
                raise DeliveryError(f"the server answered {status}: {body}")
            self.options.log("debug", f"answer {status}, trying again")
            time.sleep(max(0, wait + random.randint(-5, 4)) / 1000)
            wait = min(wait * 2, delivery.MOST_WAIT_MS)

    def close(self) -> None:
        if self.connection:
            self.connection.close()
            self.connection = None


class TcpSender:
    """A plain or TLS socket.  There is no acknowledgement.

    Challenge-response authentication signs with ``signer(challenge) -> signature``, which the
    caller brings along (no signature library is at hand here): key id and line end go
    out, a challenge line comes in, the signature's base64 and a line end go out.
    """

    def __init__(self, options: Options, signer=None):
        if options.token and signer is None:
            raise ConfigError("TCP authentication needs a signer")
        self.options, self.signer, self.requests = options, signer, 0
        self.socket: socket.socket | None = None

    def connect(self) -> None:
        if self.socket:
            raise DeliveryError("already connected")
        o = self.options
        plain = socket.create_connection((o.host, o.port), timeout=o.request_timeout / 1000)
        self.socket = o.tls().wrap_socket(plain, server_hostname=o.host) if o.secure else plain
        if o.token:
            self.socket.sendall(f"{o.username}\n".encode())
            challenge = b""
            while not challenge.endswith(b"\n"):
                if not (more := self.socket.recv(4096)):
                    raise DeliveryError("the server closed the connection before its challenge")
                challenge += more
            self.socket.sendall(base64.b64encode(self.signer(challenge[:-1])) + b"\n")

    def send(self, data: bytes) -> None:
        if not self.socket:
            self.connect()
        self.requests += 1
        self.socket.sendall(data)

    def close(self) -> None:
        if self.socket:
            self.socket.close()
            self.socket = None


def sender(options: Options, signer=None) -> HttpSender | TcpSender:
    return TcpSender(options, signer) if options.is_tcp else HttpSender(options)
