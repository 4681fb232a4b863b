"""Search and page sources behind one shape. Nothing here reaches the network unless a live provider is handed in."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Hits = list[dict[str, str]]
#: HTTP answers after which a search is tried again.
AGAIN = (429, 500, 502, 503)


class Refused(Exception):
    """A provider's answer other than success."""

    def __init__(self, status: int):
        super().__init__(f"status {status}")
        self.status = status


def shaped(items: list[dict], url: str, title: str, snippet: str) -> Hits:
    """A provider's items in the common shape, by the names of its fields."""
    return [{"url": i.get(url) or "", "title": i.get(title) or "", "snippet": i.get(snippet) or ""} for i in items]


#: Where a provider's answer keeps its items, and the names of their url, title and snippet.
SHAPES = {"serper": (("organic",), ("link", "title", "snippet")), "google_cse": (("items",), ("link", "title", "snippet")), "brave": (("web", "results"), ("url", "title", "description"))}


# Address, method, and names of the parameters of each provider's search; keys come from the settings.
REQUESTS = {
    "serper": {"method": "POST", "url": "https://google.serper.dev/search", "key": ("headers", "X-API-KEY", "SERPER_API_KEY"), "query": "q", "count": "num", "fixed": {"gl": "jp", "hl": "ja"}},
    "google_cse": {"method": "GET", "url": "https://www.googleapis.com/customsearch/v1", "key": ("params", "key", "GOOGLE_API_KEY"), "engine": ("params", "cx", "GOOGLE_CSE_ID"), "query": "q", "count": "num", "fixed": {"hl": "ja", "gl": "jp"}},
    "brave": {"method": "GET", "url": "https://api.search.brave.com/res/v1/web/search", "key": ("headers", "X-Subscription-Token", "BRAVE_API_KEY"), "query": "q", "count": "count", "fixed": {"country": "jp", "search_lang": "jp"}},
}


@dataclass(frozen=True)
class Settings:
    """Run-time settings; from_env() reads them from variables of the same names in capitals where these are set."""

    search_provider: str = "serper"
    search_qps: float = 5.0
    search_concurrency: int = 8
    verify_concurrency: int = 8
    extra_blocked_file: str = ""
    results_per_query: int = 5

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        kinds = {"search_qps": float, "search_concurrency": int, "verify_concurrency": int, "results_per_query": int}
        got = cls(**{f.name: kinds.get(f.name, str)(env[f.name.upper()]) for f in fields(cls) if f.name.upper() in env})
        if got.search_provider not in REQUESTS:
            raise ValueError(f"unknown provider {got.search_provider}; there are {', '.join(REQUESTS)}")
        return got


def request(provider: str, query: str, keys: dict[str, str], count: int = 5) -> dict:
    """What to send: method, url, headers, params and json. A missing key is an error."""
    r = REQUESTS[provider]
    out: dict = {"method": r["method"], "url": r["url"], "headers": {}, "params": {}, "json": None}
    body = {r["query"]: query, r["count"]: count, **r["fixed"]}
    for part, name, variable in (r[k] for k in ("key", "engine") if k in r):
        out[part][name] = keys[variable]
    if r["method"] == "POST":
        out["json"] = body
    else:
        out["params"] |= body
    return out


def provider_search(provider: str, keys: dict[str, str], send: Callable[[dict], tuple[int, dict]], count: int = 5) -> Callable[[str], Hits]:
    """A search for search_all(): builds the request, hands it to `send` (which gives status and body), shapes the answer."""

    def search(query: str) -> Hits:
        status, body = send(request(provider, query, keys, count))
        if status != 200:
            raise Refused(status)
        return answer(provider, body)

    return search


def robots(get: Callable[[str], tuple[int, str]], agent: str = "*") -> Callable[[str], bool]:
    """A test whether a URL may be fetched by its site's robots rules, which are asked for once a site; where there are none,
    or they can't be had, it may. For fetch_all(), where one task owns a host and so its cache."""
    known: dict[str, RobotFileParser | None] = {}

    def allowed(url: str) -> bool:
        p = urlsplit(url)
        site = f"{p.scheme}://{p.netloc}"
        if site not in known:
            known[site] = None
            try:
                status, text = get(site + "/robots.txt")
                if status == 200:
                    known[site] = RobotFileParser()
                    known[site].parse(text.splitlines())
            except Exception:  # rules that can't be had allow
                known[site] = None
        rule = known[site]
        return rule is None or rule.can_fetch(agent, url)

    return allowed


def answer(provider: str, body: dict) -> Hits:
    path, names = SHAPES[provider]
    for p in path:
        body = body.get(p) or ({} if p != path[-1] else [])
    return shaped(body, *names)


def retried(search: Callable[[str], Hits], query: str, most: int = 3, wait: Callable[[float], None] = time.sleep) -> Hits:
    """search(query), again after 2, 4 … seconds where the provider is busy; other failures go up at once."""
    for n in range(1, most + 1):
        try:
            return search(query)
        except Refused as e:
            if e.status not in AGAIN or n == most:
                raise
            wait(2.0**n)
    return []


def search_all(queries: DataFrame, search: Callable[[str], Hits], per_second: float = 5, tasks: int = 4, threads: int = 8) -> DataFrame:
    """queries (key, query) with hits: array<struct<url, title, snippet>>. The rate is shared out among the tasks; the
    first failure ends the job, and a later run takes up what is missing."""

    def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gap, begun, sent = tasks / per_second, time.monotonic(), 0
        for f in frames:

            def one(item: tuple[int, str]) -> Hits:
                time.sleep(max(0.0, begun + item[0] * gap - time.monotonic()))
                return retried(search, item[1])

            with ThreadPoolExecutor(threads) as pool:
                hits = list(pool.map(one, enumerate(f["query"], sent)))
            sent += len(f)
            yield pd.DataFrame({"key": f["key"], "query": f["query"], "hits": hits})

    return queries.select("key", "query").repartition(tasks).mapInPandas(go, "key string, query string, hits array<struct<url: string, title: string, snippet: string>>")


def fetch_all(urls: DataFrame, fetch: Callable[[str], str], allowed: Callable[[str], bool] = lambda u: True, delay: float = 1.0, tasks: int = 8) -> DataFrame:
    """(url, html) of urls (url), '' where a page can't be had. One task owns a host, so that a host is asked once at a
    time with `delay` seconds between; robots rules come as `allowed`, whose own failure allows."""

    def go(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for f in frames:
            pages = []
            for u in f["url"]:
                h = urlsplit(u).netloc
                time.sleep(max(0.0, last.get(h, -1e9) + delay - time.monotonic()))
                try:
                    pages.append(fetch(u) or "" if allowed(u) else "")
                except Exception:  # a page that fails is a page without text, not a failed task
                    pages.append("")
                last[h] = time.monotonic()
            yield pd.DataFrame({"url": f["url"], "html": pages})

    host = F.regexp_extract("url", "^[^/]*//([^/]*)", 1)
    return urls.select("url").where("url is not null").distinct().repartition(tasks, host).mapInPandas(go, "url string, html string")


def from_snapshot(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """(url, html) from a stored table of pages: the offline form of fetch_all."""
    return urls.select("url").where("url is not null").distinct().join(pages.select("url", "html"), "url", "left").na.fill("", ["html"])
