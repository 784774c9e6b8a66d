"""Names: scenes and indices from paths, shot and pose from file names, formatted output names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import POSE_NAME_ORDER
from .spelling import base_name, posix_path


def stem(path: Column) -> Column:
    """Last segment without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def suffix(path: Column) -> Column:
    """Lower-case last suffix without the dot, or ``""``."""
    return F.lower(F.regexp_extract(base_name(path), r".\.([^.]*)$", 1))


def scene_of(path: Column) -> Column:
    """First folder; without one the first two ``_`` tokens of the stem, or the stem."""
    folders = F.split(posix_path(path), "/")
    tokens = F.split(stem(path), "_")
    short = F.when(F.size(tokens) >= 2, F.concat_ws("_", F.slice(tokens, 1, 2))).otherwise(stem(path))
    return F.when(F.size(folders) > 1, F.element_at(folders, 1)).otherwise(short)


def temporal_index(path: Column) -> Column:
    """Last all-digit ``_`` token of the stem, 0 without one or where it is too long for an int."""
    digits = F.filter(F.split(stem(path), "_"), lambda t: t.rlike(r"^\d+$"))
    return F.coalesce(F.try_element_at(digits, F.lit(-1)).try_cast("int"), F.lit(0))


def safe_path(path: Column) -> Column:
    """Posix path, or null where it is empty, absolute or climbs (``.``, ``..`` or an empty part)."""
    p = posix_path(path)
    bad = F.exists(F.split(p, "/"), lambda x: x.isin("", ".", ".."))
    return F.when((p != "") & ~bad & ~p.rlike(r"^[A-Za-z]:"), p)


def shot_in_name(path: Column, order: tuple[str, ...] = ("CLOSE_UP", "FULL_BODY", "UPPER_BODY"), default: str = "OTHER") -> Column:
    """First shot type contained in the upper-case stem."""
    name = F.upper(stem(path))
    out = F
    for s in order:
        out = out.when(name.contains(s), s)
    return out.otherwise(default)


def pose_in_name(path: Column, default: str = "FRONT") -> Column:
    """First pose bucket contained in the upper-case stem."""
    name = F.upper(stem(path))
    out = F
    for s in POSE_NAME_ORDER:
        out = out.when(name.contains(s), s)
    return out.otherwise(default)


def one_decimal(x: Column) -> Column:
    """Half-up rounding by the expression every engine computes alike."""
    return F.floor(x * 10 + 0.5) / 10


def candidate_name(rank: Column, score: Column, shot: Column, pose: Column, name: Column) -> Column:
    """``{rank:02d}_score{score:05.1f}_{shot}_{pose}_{name}``."""
    return F.format_string("%02d_score%05.1f_%s_%s_%s", rank, one_decimal(score), shot, pose, name)


def frame_name(stem_: Column, index: Column) -> Column:
    return F.format_string("%s_%03d.png", stem_, index)


def packaged_name(trigger: str, index: Column, extension: str = "png") -> Column:
    return F.format_string(f"{trigger}_%02d.{extension}", index)


def cluster_label(index: Column, scene: Column) -> Column:
    return F.format_string("cluster_%04d_%s", index, scene)
