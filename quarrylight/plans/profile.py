"""Corpus profiles: the declarative part of extraction, checked before anything runs."""

from __future__ import annotations

import hashlib
import json
import re
from dataclasses import dataclass, field
from pathlib import Path, PurePosixPath

# Fixed values.
CATEGORIES = ("paper", "thesis", "patent", "dataset")
CANDIDATE = "source_located_not_human_verified"
ENGINE_VERSION = "2.0.0"


@dataclass(frozen=True)
class Profile:
    material_system: str
    canonical_roots: dict[str, str]
    keyword_groups: dict[str, str]
    value_unit_pattern: str
    formula_pattern: str
    inbox: str | None = None
    master_sources: list[dict] = field(default_factory=list)
    required_context: list[str] = field(default_factory=list)
    context_patterns: dict[str, str] = field(default_factory=dict)
    sha256: str = ""

    @property
    def version(self) -> str:
        """Facts of another version are screened anew."""
        return f"{ENGINE_VERSION}:{self.sha256}"

    @property
    def formula_group(self) -> int:
        """What a formula match stands for: the whole match, or the pattern's only group."""
        return re.compile(self.formula_pattern).groups


def check_context(required: object, patterns: object) -> None:
    if not isinstance(required, list) or not all(isinstance(x, str) and x.strip() for x in required) or len(set(required)) < len(required):
        raise ValueError("required_context must list distinct nonempty names")
    if not isinstance(patterns, dict) or not set(patterns) <= set(required) or "source_page" in patterns:
        raise ValueError("context_patterns may name required fields only, and not source_page")
    for p in patterns.values():
        if not isinstance(p, str) or not p.strip() or re.search(p, "", re.IGNORECASE):
            raise ValueError("a context pattern must be nonempty and must not match empty text")


def inside(root: Path, relative: str) -> Path:
    if not relative or Path(relative).is_absolute() or ".." in PurePosixPath(relative).parts:
        raise ValueError(f"not a path within the root: {relative!r}")
    return root / relative


def from_dict(data: dict, root: Path | None = None) -> Profile:
    """Raises ValueError for whatever breaks the contract; the fingerprint covers all of data."""
    if data.get("schema_version") != 1:
        raise ValueError("schema_version must be 1")
    roots = data.get("canonical_roots")
    if not isinstance(roots, dict) or not roots or not set(roots) <= set(CATEGORIES):
        raise ValueError(f"canonical_roots must map some of {CATEGORIES}")
    base = root or Path("/")
    paths = [inside(base, p) for p in roots.values()] + ([inside(base, data["inbox"])] if data.get("inbox") else [])
    if any(a == b or a in b.parents for i, a in enumerate(paths) for j, b in enumerate(paths) if i != j):
        raise ValueError("roots must not overlap")
    groups = data.get("keyword_groups", {})
    for p in (*groups.values(), data.get("value_unit_pattern"), data.get("formula_pattern")):
        if not isinstance(p, str) or not p:
            raise ValueError("patterns must be nonempty strings")
        try:
            re.compile(p)
        except re.error as e:
            raise ValueError(f"bad pattern {p!r}: {e}") from e
    if re.compile(data["formula_pattern"]).groups > 1:
        raise ValueError("formula_pattern may have one group at most")
    rules = data.get("evidence_rules", {})
    if rules.get("candidate_status", CANDIDATE) != CANDIDATE:
        raise ValueError("candidates can't be promoted by a profile")
    if root and rules.get("reference") and not inside(root, rules["reference"]).is_file():
        raise ValueError("the reference file of evidence_rules is missing")
    check_context(rules.get("required_context", []), rules.get("context_patterns", {}))
    sha = hashlib.sha256(json.dumps(data, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    return Profile(
        data.get("material_system", ""), dict(roots), dict(groups), data["value_unit_pattern"], data["formula_pattern"], data.get("inbox"), list(data.get("master_sources", [])),
        list(rules.get("required_context", [])), dict(rules.get("context_patterns", {})), sha,
    )


def load(path: Path, root: Path) -> Profile:
    return from_dict(json.loads(path.read_text("utf-8")), root)


def preflight(profile: Profile, root: Path, suffixes: tuple[str, ...] = (".pdf", ".md", ".txt", ".csv", ".xlsx", ".json", ".zip", ".gz"), allow_pending: bool = False) -> dict:
    """Whether a run may start: missing roots and files that wait in the inbox block it. Counts files of each root."""
    missing, counts = [], {}
    for category, relative in profile.canonical_roots.items():
        place = root / relative
        if place.is_dir():
            counts[category] = sum(p.is_file() for p in place.rglob("*"))
        else:
            missing.append(relative)
    box = root / profile.inbox if profile.inbox else None
    pending = sorted(str(p.relative_to(root)) for p in box.rglob("*") if p.is_file() and p.suffix.lower() in suffixes and p.name.lower() != "readme.md") if box and box.is_dir() else []
    return {"missing_roots": missing, "pending_inbox": pending, "file_counts": counts, "ready": not missing and (allow_pending or not pending)}
