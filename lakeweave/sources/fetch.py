"""Web resources to artifacts, fetched by the tasks; what fails is a row with an error and never a failed task."""

from __future__ import annotations

import http.client
import socket
from collections.abc import Callable
from urllib.parse import unquote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame

FETCHED = "uri string, source string, filename string, media_type string, content binary, status int, final_uri string, error string"
#: Statuses that redirect, and media types by extension.
REDIRECTS = {301, 302, 303, 307, 308}
MEDIA = {"txt": "text/plain", "md": "text/markdown", "html": "text/html", "htm": "text/html", "xml": "text/xml", "pdf": "application/pdf"}
STEP = 1 << 16


class Failed(Exception):
    """A resource that can't or mustn't be fetched."""


def _checked(uri: str, what: str = "resource"):
    try:
        parts = urlsplit(uri)
        parts.port  # noqa: B018  raises for a bad port
    except ValueError:
        raise Failed(f"invalid {what}") from None
    if parts.scheme.lower() not in ("http", "https") or not parts.hostname:
        raise Failed(f"{what} is not http(s)")
    if parts.username or parts.password:
        raise Failed(f"{what} has credentials")
    return parts


def _ask(parts, timeout: float) -> tuple[http.client.HTTPConnection, http.client.HTTPResponse]:
    kind = http.client.HTTPSConnection if parts.scheme.lower() == "https" else http.client.HTTPConnection
    link = kind(parts.hostname, parts.port, timeout=timeout)
    link.request("GET", (parts.path or "/") + (f"?{parts.query}" if parts.query else ""), headers={"User-Agent": "lakeweave", "Accept": "*/*"})
    return link, link.getresponse()


def fetch(uri: str, media_type: str = "", *, max_bytes: int = 50 << 20, max_redirects: int = 5, timeout: float = 30.0, allow: Callable[[str], bool] | None = None) -> dict:
    """One resource. Redirects are followed by hand, each target is checked (and asked about by ``allow``), and a body is read
    up to ``max_bytes`` whatever its header declares."""
    now, hops = uri, 0
    while True:
        try:
            link, answer = _ask(_checked(now, "redirect target" if hops else "resource"), timeout)
        except (OSError, http.client.HTTPException, socket.timeout) as e:
            raise Failed(type(e).__name__) from None
        try:
            if answer.status in REDIRECTS:
                target = (answer.getheader("Location") or "").strip()
                if not target:
                    raise Failed("redirect without a location")
                now, hops = urljoin(now, target), hops + 1
                _checked(now, "redirect target")
                if allow is not None and not allow(now):
                    raise Failed("redirect blocked")
                if hops > max_redirects:
                    raise Failed("too many redirects")
                continue
            if answer.status >= 400:
                raise Failed(f"status {answer.status}")
            declared = answer.getheader("Content-Length") or ""
            if declared.isdigit() and int(declared) > max_bytes:
                raise Failed("too large")
            body = bytearray()
            while part := answer.read(STEP):
                body += part
                if len(body) > max_bytes:
                    raise Failed("too large")
            name = unquote(urlsplit(now).path.rsplit("/", 1)[-1])
            kind = (answer.getheader("Content-Type") or "").split(";")[0].strip().lower()
            return {"filename": name, "media_type": kind or media_type or MEDIA.get(name.rsplit(".", 1)[-1].lower(), "application/octet-stream"), "content": bytes(body), "status": answer.status, "final_uri": now}
        except (OSError, http.client.HTTPException) as e:
            raise Failed(type(e).__name__) from None
        finally:
            link.close()


def fetched(resources: DataFrame, **options) -> DataFrame:
    """Artifacts of resources (uri, source, media_type). A batch's bodies are given out one by one, so a task holds one at a time."""

    def run(frames):
        for pdf in frames:
            for uri, source, media in zip(pdf["uri"], pdf["source"], pdf["media_type"], strict=True):
                row = dict.fromkeys(("filename", "media_type", "content", "status", "final_uri", "error")) | {"uri": uri, "source": source}
                try:
                    row |= fetch(uri or "", media or "", **options)
                except Failed as e:
                    row["error"] = str(e)
                yield pd.DataFrame([row]).astype({"status": "Int32"})[["uri", "source", "filename", "media_type", "content", "status", "final_uri", "error"]]

    return resources.select("uri", "source", "media_type").mapInPandas(run, FETCHED)
