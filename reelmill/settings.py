"""Settings of the curation steps: defaults, merging, a fingerprint, and confined paths."""

from __future__ import annotations

import copy
import hashlib
import json
import os
import re
from dataclasses import dataclass
from pathlib import Path
from typing import Any
from urllib.parse import parse_qs, urlsplit

# ---- fixed values: weights, thresholds and counts that results depend on -----------------------------------------
SELECTION: dict[str, Any] = {
    "sample_frames": 12,
    "candidate_pool_size": 110,
    "final_shortlist_min": 75,
    "final_shortlist_max": 90,
    "keyframes_per_clip": 5,
    "source_minimum": 20,
    "source_maximum_fraction": 0.50,
    "event_thresholds": {"low_max": 0.24, "high_min": 0.36},
    "hardcase_tag_threshold": 0.65,
    "score_weights": {"event_likelihood": 0.42, "hardcase": 0.28, "diversity": 0.18, "activity": 0.12},
    "event_weights": {"foreground_occupancy": 0.34, "activity": 0.27, "persistence": 0.21, "visual_variation": 0.18},
    "hardcase_weights": {"small_far": 0.18, "occlusion": 0.14, "boundary_edge": 0.14, "blur": 0.16, "crowded": 0.16, "fast_motion": 0.12, "low_light": 0.10},
    "selection_level_minimums": {"LOW": 18, "MEDIUM": 30, "HIGH": 18},
    "selected_hardcase_minimum": 25,
    "selected_normal_minimum": 25,
    "temporal_adjacency_sec": 11.0,
    "adjacent_similarity_threshold": 0.86,
    "content_similarity_threshold": 0.95,
}


class SettingsError(ValueError):
    pass


def merged(configured: dict[str, Any] | None, defaults: dict[str, Any] = SELECTION) -> dict[str, Any]:
    """Defaults with what is configured; tables are merged key by key. ``shortlist_size`` is an older name of the pool size."""
    out, given = copy.deepcopy(defaults), dict(configured or {})
    if "shortlist_size" in given:
        given.setdefault("candidate_pool_size", given.pop("shortlist_size"))
    for key, value in given.items():
        if isinstance(value, dict) and isinstance(out.get(key), dict):
            out[key] |= value
        else:
            out[key] = value
    return out


def fingerprint(settings: dict[str, Any], keys: tuple[str, ...] = ("sample_frames", "keyframes_per_clip", "event_thresholds", "hardcase_tag_threshold", "event_weights", "hardcase_weights")) -> str:
    """SHA-256 of the settings an analysis depends on, as canonical JSON."""
    part = {k: settings.get(k) for k in keys}
    return hashlib.sha256(json.dumps(part, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


@dataclass(frozen=True)
class Confined:
    """Paths below a root; what would leave it is refused."""

    root: Path
    work: str = "data"

    def at(self, relative: str) -> Path:
        path = (self.root / relative).resolve()
        if not path.is_relative_to(self.root.resolve()):
            raise SettingsError(f"path escapes the root: {relative!r}")
        return path

    def output(self, relative: str) -> Path:
        return self.at(os.path.join(self.work, relative))


def read_settings(path: str) -> dict[str, Any]:
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f)
    if not isinstance(data, dict):
        raise SettingsError("settings must be a mapping")
    return data


@dataclass(frozen=True)
class Channel:
    id: str
    url: str
    enabled: bool = True
    video_ids: tuple[str, ...] = ()
    title_keywords: tuple[str, ...] = ()
    live_keywords: tuple[str, ...] = ()
    vod_keywords: tuple[str, ...] = ()


@dataclass(frozen=True)
class Acquisition:
    channels: tuple[Channel, ...]
    mode: str = "allowlist"
    poll_interval_sec: int = 180
    max_attempts: int = 3
    retry_delay_sec: int = 60
    recovery_from_replay: bool = True
    try_from_start: bool = True
    max_height: int = 1080
    output_root: str = "data/raw"


#: Where each value stands in a registry file: (section or None, key). Values without a section of their own stand at the top.
PLACES = {
    "poll_interval_sec": (None, "poll_interval_sec"),
    "output_root": ("output", "root_dir"),
    "max_height": ("download", "max_height"),
    "merge_format": ("download", "merge_format"),
    "try_from_start": ("live", "try_from_start"),
    "recovery_from_replay": ("live", "recovery_from_replay"),
    "max_attempts": ("retry", "max_attempts"),
    "retry_delay_sec": ("retry", "retry_delay_sec"),
    "mode": ("selection", "mode"),
}
KEYWORDS = ("title_keywords", "live_keywords", "vod_keywords")
VIDEO_ID = re.compile(r"[A-Za-z0-9_-]{11}")
#: Hosts and the paths before an id in links to one item. Fixed values.
WATCH_HOSTS = ("youtube.com", "www.youtube.com", "m.youtube.com")
SHORT_HOST = "youtu.be"


def video_id_of(reference: str) -> str:
    """The id in a bare id or a link to one item; anything else is an error."""
    text = reference.strip()
    found = text
    if "://" in text:
        link = urlsplit(text)
        host, parts = (link.hostname or "").lower(), link.path.strip("/").split("/")
        found = ""
        if link.scheme == "https" and host in WATCH_HOSTS:
            if link.path == "/watch":
                found = parse_qs(link.query).get("v", [""])[0]
            elif parts[0] in ("live", "shorts") and len(parts) > 1:
                found = parts[1]
        elif link.scheme == "https" and host == SHORT_HOST:
            found = parts[0]
    if not VIDEO_ID.fullmatch(found):
        raise SettingsError(f"no item id in {reference!r}")
    return found


def _words(value: Any, name: str) -> tuple[str, ...]:
    if not isinstance(value, list) or not all(isinstance(x, str) and x.strip() for x in value):
        raise SettingsError(f"{name} must be a list of texts that aren't blank")
    return tuple(x.strip() for x in value)


def _channel(row: Any) -> Channel:
    if not isinstance(row, dict) or not {"id", "url"} <= row.keys():
        raise SettingsError("a channel needs an id and a url")
    if unknown := row.keys() - {"id", "url", "enabled", "video_ids", *KEYWORDS}:
        raise SettingsError(f"unknown channel settings: {', '.join(sorted(map(str, unknown)))}")
    name, url = str(row["id"]), str(row["url"])
    if not re.sub("[-_]", "", name).isalnum():
        raise SettingsError(f"bad channel id {name!r}")
    if not url.startswith("https://www.youtube.com/"):
        raise SettingsError(f"bad channel url {url!r}")
    ids = row.get("video_ids", [])
    if not isinstance(ids, list):
        raise SettingsError("video_ids must be a list")
    return Channel(name, url, bool(row.get("enabled", True)), tuple(video_id_of(str(x)) for x in ids), *(_words(row.get(k, []), k) for k in KEYWORDS))


def _value(data: dict[str, Any], name: str) -> Any:
    section, key = PLACES[name]
    part = data if section is None else data.get(section)
    if part is None and name == "mode":
        return "allowlist"
    if not isinstance(part, dict) or key not in part:
        if name == "mode" and isinstance(part, dict):
            return "allowlist"
        raise SettingsError(f"missing setting {key if section is None else f'{section}.{key}'}")
    return part[key]


def channel_registry(data: dict[str, Any], root: Path) -> Acquisition:
    """A validated registry: channels with unique safe ids and links, unique item ids, positive numbers, an output below the root.

    Settings stand in sections; one that nobody knows is an error, not something to be passed over.
    """
    if not isinstance(data, dict):
        raise SettingsError("settings must be a mapping")
    for section in {s for s, _ in PLACES.values() if s}:
        if isinstance(data.get(section), dict) and (unknown := data[section].keys() - {k for s, k in PLACES.values() if s == section}):
            raise SettingsError(f"unknown settings in {section}: {', '.join(sorted(map(str, unknown)))}")
    if unknown := data.keys() - {"channels", *(s or k for s, k in PLACES.values())}:
        raise SettingsError(f"unknown settings: {', '.join(sorted(map(str, unknown)))}")
    rows = data.get("channels")
    if not isinstance(rows, list) or not rows:
        raise SettingsError("channels must be a list with at least one entry")
    channels = tuple(_channel(r) for r in rows)
    if len({c.id for c in channels}) != len(channels):
        raise SettingsError("a channel id stands twice")
    ids = [v for c in channels for v in c.video_ids]
    if len(set(ids)) != len(ids):
        raise SettingsError("an item id stands twice")
    got = {name: _value(data, name) for name in PLACES}
    try:
        numbers = {k: int(got[k]) for k in ("poll_interval_sec", "max_height", "max_attempts", "retry_delay_sec")}
    except (TypeError, ValueError) as e:
        raise SettingsError("intervals, height and attempts must be numbers") from e
    if min(numbers["poll_interval_sec"], numbers["max_height"], numbers["max_attempts"]) < 1 or numbers["retry_delay_sec"] < 0:
        raise SettingsError("intervals, height and attempts must be positive")
    if str(got["mode"]) not in ("allowlist", "all"):
        raise SettingsError("selection.mode must be allowlist or all")
    if str(got["merge_format"]) != "mp4":
        raise SettingsError("only mp4 is supported")
    output = str(got["output_root"])
    if os.path.isabs(output):
        raise SettingsError("output.root_dir must be relative")
    Confined(root).at(output)
    return Acquisition(channels, str(got["mode"]), numbers["poll_interval_sec"], numbers["max_attempts"], numbers["retry_delay_sec"], bool(got["recovery_from_replay"]), bool(got["try_from_start"]), numbers["max_height"], output)


#: Thresholds of technical quality where neither a ``qc`` nor a ``clip`` section says otherwise. Fixed values.
QUALITY = {"min_duration_sec": 30.0, "max_duration_sec": 180.0, "expected_overlap_sec": 0.0, "overlap_tolerance_sec": 0.5}


def quality_settings(data: dict[str, Any]) -> dict[str, Any]:
    """Thresholds of technical quality: what ``qc`` says, else what follows from ``clip``, else the defaults."""
    clip, own = data.get("clip") or {}, data.get("qc") or {}
    derived = {k: float(clip[c]) for k, c in (("min_duration_sec", "min_duration_sec"), ("max_duration_sec", "max_duration_sec"), ("expected_overlap_sec", "overlap_sec")) if c in clip}
    return QUALITY | derived | own
