"""Control of a whole run: which stage follows, what is reused, what counts as done."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import TypeVar

T = TypeVar("T")


def first_success(attempts: Iterable[tuple[str, Callable[[], T | None]]]) -> tuple[str, T]:
    """The first attempt that gives a result, with its name; RuntimeError if none does."""
    failed = []
    for name, attempt in attempts:
        try:
            got = attempt()
        except Exception as e:  # noqa: BLE001  the next attempt stands in
            failed.append(f"{name}: {e}")
            continue
        if got is not None:
            return name, got
        failed.append(f"{name}: no result")
    raise RuntimeError("nothing succeeded: " + "; ".join(failed))


def needs_retry(mapper: str, reg_rate: float, reused: bool) -> bool:
    """Whether a global reconstruction registered too little and is tried again incrementally."""
    return mapper == "global" and reg_rate < 0.80 and not reused


@dataclass(frozen=True)
class DensifyState:
    has_cloud: bool = False
    wanted: bool = True
    n_points: int = 0
    cached_depth: int = 0
    n_images: int = 0
    has_lidar: bool = False


def densify_branch(s: DensifyState) -> str:
    """`reuse`, `skip`, `too_few`, `cached`, `lidar` or `images`, in that order of preference.

    Kept depth counts only if there is a raster for every image.
    """
    if s.has_cloud:
        return "reuse"
    if not s.wanted:
        return "skip"
    if s.n_points < 1000:
        return "too_few"
    if s.n_images and s.cached_depth >= s.n_images:
        return "cached"
    return "lidar" if s.has_lidar else "images"


def placement(has_lidar: bool, telemetry: bool, align_up: bool, telemetry_succeeded: bool) -> list[str]:
    """The placement stages that run: a scan excludes telemetry, and a georegistered model isn't turned again."""
    stages = ["telemetry"] if telemetry and not has_lidar else []
    if align_up and not (stages and telemetry_succeeded):
        stages.append("align_up")
    return stages


def exit_code(valid: bool) -> int:
    return 0 if valid else 1
