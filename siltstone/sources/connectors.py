"""Providers over HTTP: what files or pages a target has, and one of them as a raw document.

A client is any callable (url, headers) -> (status, body). Listing raises on a failure; fetching gives
None for what is no readable file, so that one file never ends a run.
"""

from __future__ import annotations

import base64
import hashlib
import json
import logging
import urllib.error
import urllib.request
from collections.abc import Callable
from urllib.parse import quote

from siltstone.functions.html import to_markdown
from siltstone.functions.paths import EXCLUDED, EXTENSIONS, PYTHON_TESTS, SCRIPT_TESTS
from siltstone.sources.targets import Target, auth_header

Client = Callable[[str, dict[str, str]], tuple[int, bytes]]
log = logging.getLogger(__name__)
DEPTH, PAGE, WIKI_PAGE = 25, 100, 100


def http(url: str, headers: dict[str, str]) -> tuple[int, bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=60) as r:
            return r.status, r.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


def ingestible(path: str) -> bool:
    """functions.paths.is_ingestible for one string."""
    import re

    name = path.rpartition("/")[2]
    return "." in path and path[path.rindex(".") :] in EXTENSIONS and not any(x in path for x in EXCLUDED) and not re.search(SCRIPT_TESTS, path) and not re.search(PYTHON_TESTS, name)


def language(path: str) -> str:
    return {"java": "java", "py": "python", "ts": "typescript", "tsx": "typescript"}.get(path.rpartition(".")[2], "javascript")


def changed_ingestible(paths: list[str]) -> list[str]:
    """Of the paths in a push event, those that are taken."""
    return [p for p in paths if ingestible(p)]


class Connector:
    provider = ""
    basic_only = False

    def __init__(self, target: Target, token: str | None = None, email: str | None = None, client: Client = http, base: str | None = None):
        self.target, self.client, self.base = target, client, (base or self.default_base).rstrip("/")
        self.headers = auth_header(token, email, self.basic_only)
        self._ref: str | None = target.ref

    default_base = ""

    def json(self, url: str):
        status, body = self.client(url, self.headers)
        if not 200 <= status < 300:
            raise OSError(f"{self.provider}: {status} for {url}")
        return json.loads(body)

    @property
    def ref(self) -> str:
        if self._ref is None:
            self._ref = self.default_branch() or "main"
        return self._ref

    def default_branch(self) -> str | None:
        raise NotImplementedError

    def list(self) -> list[str]:
        raise NotImplementedError

    def content(self, path: str) -> str | None:
        raise NotImplementedError

    def url(self, path: str) -> str:
        raise NotImplementedError

    def fetch(self, path: str) -> dict | None:
        text = self.content(path)
        if text is None:
            return None
        return {
            "source_type": "code", "source_id": f"{self.provider}:{self.target.name}:{path}", "content": text, "repo": self.target.name, "provider": self.provider, "ref": self.ref,
            "file_path": path, "language": language(path), "url": self.url(path), "content_hash": hashlib.sha256(text.encode()).hexdigest(),
        }


class GitHub(Connector):
    provider, default_base = "github", "https://api.github.com"

    def default_branch(self) -> str | None:
        return self.json(f"{self.base}/repos/{self.target.name}").get("default_branch")

    def list(self) -> list[str]:
        tree = self.json(f"{self.base}/repos/{self.target.name}/git/trees/{quote(self.ref, safe='')}?recursive=1")
        if tree.get("truncated"):
            log.warning("the tree of %s is truncated; some files are not listed", self.target.name)
        return [x["path"] for x in tree.get("tree") or [] if x.get("type") == "blob" and x.get("path") and ingestible(x["path"])]

    def content(self, path: str) -> str | None:
        found = self.json(f"{self.base}/repos/{self.target.name}/contents/{quote(path)}?ref={quote(self.ref, safe='')}")
        if isinstance(found, list) or found.get("type") != "file" or "content" not in found:
            return None
        return base64.b64decode(found["content"]).decode("utf-8", "replace")

    def url(self, path: str) -> str:
        return f"https://github.com/{self.target.name}/blob/{self.ref}/{path}"


class GitLab(Connector):
    provider, default_base = "gitlab", "https://gitlab.com"

    @property
    def project(self) -> str:
        return f"{self.base}/api/v4/projects/{quote(self.target.name, safe='')}"

    def default_branch(self) -> str | None:
        return self.json(self.project).get("default_branch")

    def list(self) -> list[str]:
        out, page = [], 1
        while True:
            found = self.json(f"{self.project}/repository/tree?ref={quote(self.ref, safe='')}&recursive=true&per_page={PAGE}&page={page}")
            out += [x["path"] for x in found if x.get("type") == "blob" and x.get("path") and ingestible(x["path"])]
            if len(found) < PAGE:
                return out
            page += 1

    def content(self, path: str) -> str | None:
        status, body = self.client(f"{self.project}/repository/files/{quote(path, safe='')}/raw?ref={quote(self.ref, safe='')}", self.headers)
        return body.decode("utf-8", "replace") if 200 <= status < 300 else None

    def url(self, path: str) -> str:
        return f"{self.base}/{self.target.name}/-/blob/{self.ref}/{path}"


class Bitbucket(Connector):
    provider, default_base = "bitbucket", "https://api.bitbucket.org/2.0"

    def default_branch(self) -> str | None:
        return (self.json(f"{self.base}/repositories/{self.target.name}").get("mainbranch") or {}).get("name")

    def list(self) -> list[str]:
        out, url = [], f"{self.base}/repositories/{self.target.name}/src/{self.ref}/?max_depth={DEPTH}&pagelen={PAGE}"
        while url:
            status, body = self.client(url, self.headers)
            if status == 555:  # the walk took too long: what is there so far
                log.warning("listing %s timed out at depth %d; some files are not listed", self.target.name, DEPTH)
                break
            if not 200 <= status < 300:
                raise OSError(f"bitbucket: {status} for {url}")
            found = json.loads(body)
            out += [x["path"] for x in found["values"] if x.get("type") == "commit_file" and ingestible(x["path"])]
            url = found.get("next")
        return out

    def content(self, path: str) -> str | None:
        status, body = self.client(f"{self.base}/repositories/{self.target.name}/src/{self.ref}/{quote(path)}", self.headers)
        return body.decode("utf-8", "replace") if 200 <= status < 300 else None

    def url(self, path: str) -> str:
        return f"https://bitbucket.org/{self.target.name}/src/{self.ref}/{path}"


class Confluence(Connector):
    """Pages of a space; base is the site with /wiki. Ids are listed with titles and parents, which give
    the path of titles that a fetched page is named by."""

    provider, basic_only = "confluence", True

    def __init__(self, *args, **kwargs):
        super().__init__(*args, **kwargs)
        self.pages: dict[str, tuple[str, str | None]] = {}
        self.origin = "/".join(self.base.split("/")[:3])
        self._space: str | None = None

    @property
    def api(self) -> str:
        return f"{self.base}/api/v2"

    @property
    def space(self) -> str:
        if self._space is None:
            found = self.json(f"{self.api}/spaces?keys={quote(self.target.name)}")["results"]
            if not found:
                raise OSError(f"confluence: no space {self.target.name}")
            self._space = found[0]["id"]
        return self._space

    def list(self) -> list[str]:
        out, url = [], f"{self.api}/spaces/{self.space}/pages?status=current&limit={WIKI_PAGE}"
        while url:
            found = self.json(url)
            for p in found["results"]:
                out.append(p["id"])
                self.pages[p["id"]] = (p["title"], p.get("parentId"))
            after = (found.get("_links") or {}).get("next")
            url = f"{self.origin}{after}" if after else None
        return out

    def breadcrumb(self, page: str, title: str) -> str:
        titles, seen, at = [title], set(), self.pages.get(page, ("", None))[1]
        while at and at not in seen and at in self.pages:
            seen.add(at)
            titles.append(self.pages[at][0])
            at = self.pages[at][1]
        return " / ".join(reversed(titles))

    def labels(self, page: str) -> list[str]:
        try:
            return [x["name"] for x in self.json(f"{self.api}/pages/{page}/labels")["results"]]
        except Exception as e:  # labels are not worth a page
            log.warning("labels of page %s: %s", page, e)
            return []

    def fetch(self, path: str) -> dict | None:
        status, body = self.client(f"{self.api}/pages/{path}?body-format=view", self.headers)
        if not 200 <= status < 300:
            return None
        page = json.loads(body)
        text = to_markdown(((page.get("body") or {}).get("view") or {}).get("value") or "")
        shown = (page.get("_links") or {}).get("webui")
        return {
            "source_type": "confluence", "source_id": f"confluence:{self.target.name}:{path}", "content": text, "repo": self.target.name, "provider": "confluence",
            "file_path": self.breadcrumb(path, page["title"]), "url": f"{self.base}{shown}" if shown else None, "last_modified": (page.get("version") or {}).get("createdAt"),
            "labels": self.labels(path), "content_hash": hashlib.sha256(text.encode()).hexdigest(),
        }


CONNECTORS: dict[str, type[Connector]] = {c.provider: c for c in (GitHub, GitLab, Bitbucket, Confluence)}


def connect(target: Target, **options) -> Connector:
    return CONNECTORS[target.provider](target, **options)
