"""What to sync, as a user names it: owner/repo, gitlab:group/project, bitbucket:workspace/repo or confluence:SPACE."""

from __future__ import annotations

import base64
from dataclasses import dataclass


@dataclass(frozen=True)
class Target:
    provider: str
    name: str  # owner/repo, project path, workspace/repo, or space key
    ref: str | None = None

    @property
    def label(self) -> str:
        """What the run calls the repository; a space keeps its prefix here, though its rows do not have it."""
        return f"confluence:{self.name}" if self.provider == "confluence" else self.name


def parse_target(text: str, ref: str | None = None) -> Target:
    if not text:
        raise ValueError("usage: [gitlab:|bitbucket:|confluence:]NAME [REF]")
    prefix, colon, rest = text.partition(":")
    if colon and prefix == "confluence":
        return Target("confluence", rest)
    if colon and prefix == "gitlab":
        return Target("gitlab", rest, ref)
    if colon and prefix == "bitbucket":
        return Target("bitbucket", "/".join(rest.split("/")[:2]), ref)
    return Target("github", "/".join(text.split("/")[:2]), ref)


def auth_header(token: str | None, email: str | None = None, basic_only: bool = False) -> dict[str, str]:
    """Basic for an email with a token, Bearer for a token alone (nothing where only Basic is known), else anonymous."""
    if token and email:
        return {"Authorization": "Basic " + base64.b64encode(f"{email}:{token}".encode()).decode()}
    if token and not basic_only:
        return {"Authorization": f"Bearer {token}"}
    return {}
