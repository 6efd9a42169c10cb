"""Bounded GET requests to public hosts, for the readers of ``feeds``.

Every hop of a redirect is checked anew, since a public name may lead to a
private address; bodies are read up to a cap; refusals that pass are tried again.
"""

from __future__ import annotations

import http.client
import ipaddress
import json
import socket
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

RETRIES, REDIRECTS, PASSING = 3, 5, frozenset({429, 500, 502, 503, 504})
MOST_BYTES, SECONDS, PAUSE = 32 << 20, 30, 0.4


class Unsafe(ValueError):
    """An address that isn't public, or a URL that says more than a place."""


class TooLarge(ValueError):
    """A body beyond the cap."""


def resolve(host: str, port: int | None) -> list[str]:
    return sorted({a[4][0] for a in socket.getaddrinfo(host, port or 443, type=socket.SOCK_STREAM)})


def public_url(url: str, resolver: Callable[[str, int | None], list[str]] = resolve) -> str:
    """The URL in normal form; fails unless each address of its host is global."""
    try:
        u = urllib.parse.urlsplit(str(url).strip())
        port = u.port
        host = (u.hostname or "").encode("idna").decode("ascii").lower()
    except (ValueError, UnicodeError) as e:
        raise Unsafe(f"malformed: {url}") from e
    if u.scheme.lower() not in ("http", "https") or not host or u.username is not None or u.password is not None:
        raise Unsafe(f"not a plain http address: {url}")
    try:
        found = [str(ipaddress.ip_address(host))]
    except ValueError:
        found = list(resolver(host, port))
    if not found or not all(ipaddress.ip_address(a.split("%")[0]).is_global for a in found):
        raise Unsafe(f"not a public host: {host}")
    shown = (f"[{host}]" if ":" in host else host) + (f":{port}" if port else "")
    return urllib.parse.urlunsplit((u.scheme.lower(), shown, u.path or "/", u.query, ""))


class _Stay(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *_):
        return None


def _body(answer, most: int) -> bytes:
    said = answer.headers.get("Content-Length", "")
    if said.isdigit() and int(said) > most:
        raise TooLarge(f"{said} bytes declared, {most} allowed")
    got = answer.read(most + 1)
    if len(got) > most:
        raise TooLarge(f"more than {most} bytes")
    return got


def get(url: str, params: dict | None = None, most: int = MOST_BYTES, check: Callable[[str], str] = public_url, pause: float = PAUSE) -> bytes:
    """A body. ``check`` passes or refuses each hop's URL and gives its normal form."""
    opener = urllib.request.build_opener(_Stay)
    at = check(url)
    if params:
        at += ("&" if "?" in at else "?") + urllib.parse.urlencode(params)
    tries = 0
    for _ in range(REDIRECTS + 1):
        while True:
            try:
                with opener.open(urllib.request.Request(at, headers={"Accept": "application/json, application/xml, text/xml, */*"}), timeout=SECONDS) as answer:
                    return _body(answer, most)
            except urllib.error.HTTPError as e:
                with e:
                    if 300 <= e.code < 400:
                        to = e.headers.get("Location")
                        if not to:
                            raise Unsafe("a redirect to nowhere") from e
                        at = check(urllib.parse.urljoin(at, to))
                        break
                    if e.code not in PASSING or tries >= RETRIES:
                        raise
                    wait = e.headers.get("Retry-After", "")
            except (urllib.error.URLError, http.client.HTTPException, TimeoutError):
                if tries >= RETRIES:
                    raise
                wait = ""
            time.sleep(min(SECONDS, int(wait)) if wait.isdigit() else pause * 2**tries)
            tries += 1
    raise Unsafe("too many redirects")


def get_json(url: str, params: dict | None = None, **more) -> dict:
    found = json.loads(get(url, params, **more))
    if not isinstance(found, dict):
        raise ValueError("expected a JSON object")
    return found
