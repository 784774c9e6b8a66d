"""Pixel kernels on NumPy arrays, and Arrow UDFs that apply them to array columns.

Decoding pictures, landmarks and neural models come from outside: their outputs are columns. Asking for
a model kernel here raises :class:`ModelRequired`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class ModelRequired(RuntimeError):
    """The kernel needs a model or decoder that is not part of this package."""


# Numbers of face-mesh points, the corners of both eyes and the outline's forehead, cheek, chin and cheek.
EYES = ((33, 133), (263, 362))
OUTLINE = (10, 234, 152, 454)


def _reflect(gray: np.ndarray) -> np.ndarray:
    return np.pad(gray.astype(np.float64), 1, mode="reflect" if min(gray.shape) > 1 else "edge")


def laplacian(gray: np.ndarray) -> np.ndarray:
    """Four-neighbour second difference, mirrored at the border."""
    p = _reflect(gray)
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]


def gradients(gray: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sobel differences along x and y."""
    p = _reflect(gray)
    right, left = p[:, 2:], p[:, :-2]
    dx = (right - left)[:-2] + 2 * (right - left)[1:-1] + (right - left)[2:]
    down = p[2:] - p[:-2]
    dy = down[:, :-2] + 2 * down[:, 1:-1] + down[:, 2:]
    return dx, dy


def technical_metrics(gray: np.ndarray) -> dict[str, float]:
    """Sharpness, exposure and contrast of a grey picture, at three decimals."""
    dx, dy = gradients(gray)
    p10, p90 = np.percentile(gray, [10, 90])
    values = {
        "laplacian_score": laplacian(gray).var(),
        "tenengrad_score": (dx * dx + dy * dy).mean(),
        "brightness_mean": gray.mean(),
        "brightness_std": gray.std(),
        "shadow_pixel_ratio": (gray < 40).mean(),
        "highlight_pixel_ratio": (gray > 235).mean(),
        "contrast_p90_p10": p90 - p10,
    }
    return {k: round(float(v), 3) for k, v in values.items()}


def sharpness(gray: np.ndarray) -> tuple[float, float]:
    dx, dy = gradients(gray)
    return float(laplacian(gray).var()), float((dx * dx + dy * dy).mean())


def patch_sharpness(patch: np.ndarray) -> float:
    """90th percentile of the gradient over the patch's deviation; 0 below three pixels a side."""
    if patch.size == 0 or min(patch.shape) < 3:
        return 0.0
    dx, dy = gradients(patch)
    return float(np.percentile(np.hypot(dx, dy), 90) / (patch.std() + 1e-4))


def skin_texture(patches: list[np.ndarray]) -> float:
    """Mean over usable patches of the Laplacian's variance per brightness."""
    scores = [laplacian(p).var() / max(float(p.mean()), 10.0) for p in patches if p.size and min(p.shape) >= 3]
    return float(np.mean(scores)) if scores else 0.0


def landmark_patch(gray: np.ndarray, corners: tuple[tuple, tuple], scale: tuple[float, float], least: tuple[float, float]) -> np.ndarray:
    """The patch around the middle of two points (shares of the picture), its sides in shares of their distance."""
    h, w = gray.shape
    (ax, ay), (bx, by) = corners
    cx, cy, span = (ax + bx) * w / 2, (ay + by) * h / 2, math.hypot((ax - bx) * w, (ay - by) * h)
    pw, ph = max(span * scale[0], least[0]), max(span * scale[1], least[1])
    return gray[max(0, int(cy - ph / 2)) : max(0, min(h, int(cy + ph / 2))), max(0, int(cx - pw / 2)) : max(0, min(w, int(cx + pw / 2)))]


def anatomical_sharpness(gray: np.ndarray, landmarks: list[tuple[float, float]] | None, eye_valid: bool = True) -> tuple[float, float]:
    """Sharpness of the eyes (their mean; 0 where an eye is invalid or has none) and of the mouth, from face-mesh points in shares of the picture."""
    if landmarks is None:
        return 0.0, 0.0
    mouth = patch_sharpness(landmark_patch(gray, (landmarks[61], landmarks[291]), (1.4, 0.8), (10.0, 8.0)))
    eyes = [patch_sharpness(landmark_patch(gray, (landmarks[a], landmarks[b]), (1.5, 1.2), (8.0, 8.0))) for a, b in EYES]
    return (sum(eyes) / 2 if eye_valid and min(eyes) > 0 else 0.0), mouth


def cheek_texture(gray: np.ndarray, landmarks: list[tuple[float, float]] | None, box: tuple[int, int, int, int], eye_sharpness: float) -> tuple[float, float]:
    """Skin texture of the cheeks and the plasticity ratio: the eyes' sharpness over it; both 0 without a usable cheek. The flag is ``gate.beauty_filter``."""
    if landmarks is None:
        return 0.0, 0.0
    h, w = gray.shape
    r = max(int(min(box[2], box[3]) * 0.07), 6)
    at = [(int(landmarks[i][0] * w), int(landmarks[i][1] * h)) for i in (50, 280)]
    patches = [gray[max(0, y - r) : max(0, min(h, y + r)), max(0, x - r) : max(0, min(w, x + r))] for x, y in at]
    if not any(p.size and min(p.shape) >= 3 for p in patches):
        return 0.0, 0.0
    texture = skin_texture(patches)
    return texture, float(eye_sharpness / max(texture, 0.005))


def cut_patch(picture: np.ndarray, centre: tuple[float, float], half: tuple[float, float]) -> np.ndarray:
    """The part of a picture within ``half`` (x, y) of a point, its ends in whole pixels toward 0 and inside the picture."""
    h, w = picture.shape[:2]
    (cx, cy), (rx, ry) = centre, half
    return picture[max(0, int(cy - ry)) : max(0, min(h, int(cy + ry))), max(0, int(cx - rx)) : max(0, min(w, int(cx + rx)))]


def eye_presence(saturation: np.ndarray, value: np.ndarray, landmarks: list[tuple[float, float]] | None) -> tuple[float, float]:
    """:func:`eye_features` of the left and right eye, in patches around the middle of each eye's corners; 0 without a mesh. Validity is ``gate.eyes_valid``."""
    if landmarks is None:
        return 0.0, 0.0
    h, w = value.shape
    out = []
    for a, b in EYES:
        (ax, ay), (bx, by) = landmarks[a], landmarks[b]
        span = math.hypot((ax - bx) * w, (ay - by) * h)
        middle, half = ((ax + bx) * w / 2, (ay + by) * h / 2), (max(int(span * 0.8), 8), max(int(span * 0.5), 6))
        out.append(eye_features(cut_patch(saturation, middle, half), cut_patch(value, middle, half)))
    return out[0], out[1]


def central_gradient(gray: np.ndarray, landmarks: list[tuple[float, float]] | None) -> float:
    """:func:`polygon_gradient` of the middle of the face: forehead, one cheek, chin, the other; 0 without a mesh."""
    if landmarks is None:
        return 0.0
    h, w = gray.shape
    return polygon_gradient(gray, [(int(landmarks[i][0] * w), int(landmarks[i][1] * h)) for i in OUTLINE])


def identity_crop(picture: np.ndarray, box: tuple[int | None, ...], margin: float = 0.25) -> np.ndarray:
    """The face with a margin; where there is no box, or nothing of it in the picture, the upper middle."""
    h, w = picture.shape[:2]
    left, top, right, bottom = identity_box(*[x or 0 for x in box], w, h, margin)
    return picture[top:bottom, left:right]


def identity_box(x: int, y: int, bw: int, bh: int, width: int, height: int, margin: float = 0.25) -> tuple[int, int, int, int]:
    """(left, top, right, bottom) of :func:`identity_crop`."""
    if bw > 0 and bh > 0:
        left, top, right, bottom = scaled_box((x, y, bw, bh), width, height, margin)
        if right > left and bottom > top:
            return left, top, right, bottom
    cx, cy, r = int(width * 0.5), int(height * 0.35), int(min(width, height) * 0.35)
    return max(0, cx - r), max(0, cy - r), min(width, cx + r), min(height, cy + r)


def identity_box_column(x: Column, y: Column, bw: Column, bh: Column, width: Column, height: Column, margin: float = 0.25) -> Column:
    """:func:`identity_box` as a struct of x1, y1, x2, y2, inside code generation."""
    whole = lambda v: v.cast("int")  # noqa: E731 - toward 0
    mx, my = whole(bw * margin), whole(bh * margin)
    own = [F.greatest(F.lit(0), x - mx), F.greatest(F.lit(0), y - my), F.least(width, x + bw + mx), F.least(height, y + bh + my)]
    cx, cy, r = whole(width * 0.5), whole(height * 0.35), whole(F.least(width, height) * 0.35)
    middle = [F.greatest(F.lit(0), cx - r), F.greatest(F.lit(0), cy - r), F.least(width, cx + r), F.least(height, cy + r)]
    ok = (bw > 0) & (bh > 0) & (own[2] > own[0]) & (own[3] > own[1])
    return F.struct(*[F.when(ok, a).otherwise(b).cast("int").alias(n) for n, a, b in zip(("x1", "y1", "x2", "y2"), own, middle)])


def eye_features(saturation: np.ndarray, value: np.ndarray) -> float:
    """Share of an eye patch that is white of the eye (pale and bright) or iris (dark)."""
    if not value.size:
        return 0.0
    return float(((saturation < 55) & (value > 115)).mean() + (value < 75).mean())


def polygon_gradient(gray: np.ndarray, corners: list[tuple[int, int]]) -> float:
    """Mean gradient inside a convex polygon of (x, y) corners, its edge included."""
    ys, xs = np.mgrid[: gray.shape[0], : gray.shape[1]]
    sides = [(bx - ax) * (ys - ay) - (by - ay) * (xs - ax) for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1])]
    inside = np.all([s >= 0 for s in sides], axis=0) | np.all([s <= 0 for s in sides], axis=0)
    return float(np.hypot(*gradients(gray))[inside].mean()) if inside.any() else 0.0


def opening_ratio(outer: tuple, inner: tuple, upper: tuple, lower: tuple, width: int, height: int) -> float:
    """Height of an eye over its width, from points in shares of the picture."""
    span = lambda a, b: math.hypot((a[0] - b[0]) * width, (a[1] - b[1]) * height)
    return span(upper, lower) / max(span(outer, inner), 1.0)


def pixel_box(x: float, y: float, w: float, h: float, width: int, height: int) -> tuple[int, int, int, int]:
    """A relative box in whole pixels inside the picture, rounded outward."""
    hold = lambda v, most: max(0, min(most, v))
    left, top = hold(math.floor(x * width), width), hold(math.floor(y * height), height)
    right, bottom = hold(math.ceil((x + w) * width), width), hold(math.ceil((y + h) * height), height)
    return left, top, max(0, right - left), max(0, bottom - top)


def scaled_box(box: tuple[int, int, int, int], width: int, height: int, margin: float = 0.0, core: float | None = None) -> tuple[int, int, int, int]:
    """(left, top, right, bottom) of a box with a margin on each side, or of its core of that scale."""
    x, y, w, h = box
    if core is None:
        mx, my = int(w * margin), int(h * margin)
        return max(0, x - mx), max(0, y - my), min(width, x + w + mx), min(height, y + h + my)
    cw, ch = int(w * core), int(h * core)
    cx, cy = x + w / 2, y + h / 2
    return max(0, int(cx - cw / 2)), max(0, int(cy - ch / 2)), min(width, int(cx + cw / 2)), min(height, int(cy + ch / 2))


def face_box(landmarks: list[tuple[float, float]] | None, width: int, height: int) -> tuple[int, int, int, int] | None:
    """(x, y, width, height) around all face-mesh points (shares of the picture), inside the picture; None without a face."""
    if not landmarks:
        return None
    xs, ys = [x * width for x, _ in landmarks], [y * height for _, y in landmarks]
    left, top = max(0, int(min(xs))), max(0, int(min(ys)))
    return left, top, min(width, int(max(xs))) - left, min(height, int(max(ys))) - top


def _resized(picture: np.ndarray, height: int, width: int, reach: int, kernel: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Separable resampling from 2 x ``reach`` points a side, the border repeated, weights summing to 1."""

    def weights(n: int, m: int) -> np.ndarray:
        at = (np.arange(m) + 0.5) * n / m - 0.5
        taps = np.floor(at)[:, None].astype(int) + np.arange(1 - reach, reach + 1)
        w = kernel(at[:, None] - taps)
        out = np.zeros((m, n))
        np.add.at(out, (np.arange(m)[:, None], np.clip(taps, 0, n - 1)), w / w.sum(1, keepdims=True))
        return out

    out = np.einsum("ij,jk...->ik...", weights(picture.shape[0], height), picture.astype(np.float64))
    out = np.moveaxis(np.tensordot(weights(picture.shape[1], width), out, (1, 1)), 0, 1)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8) if picture.dtype == np.uint8 else out


def lanczos(picture: np.ndarray, height: int, width: int) -> np.ndarray:
    """Resized by the Lanczos kernel of eight points a side."""
    return _resized(picture, height, width, 4, lambda t: np.sinc(t) * np.sinc(t / 4))


def aligned_picture(picture: np.ndarray, multiple: int = 16) -> np.ndarray:
    """The picture with sides at the nearest multiple, halves upward, at least one; itself where they are."""
    h, w = (max((n + multiple // 2) // multiple * multiple, multiple) for n in picture.shape[:2])
    return picture if (h, w) == picture.shape[:2] else lanczos(picture, h, w)


def comparison_strip(original: np.ndarray, restored: np.ndarray, side: int = 256) -> np.ndarray:
    """Both crops at ``side`` x ``side`` (bilinear) beside each other."""
    return np.hstack([_resized(x, side, side, 1, lambda t: np.maximum(0.0, 1 - np.abs(t))) for x in (original, restored)])


def perceptual_hash(gray: np.ndarray) -> int:
    """64-bit hash of a grey picture: low frequencies of its cosine transform against their median; a signed long."""
    small = block_mean(gray, 32, 32)
    k = np.arange(32)
    basis = np.cos(np.pi * (2 * k[None] + 1) * k[:, None] / 64) * np.where(k == 0, math.sqrt(1 / 32), math.sqrt(2 / 32))[:, None]
    low = (basis @ small @ basis.T)[:8, :8]
    bits = (low > np.median(low[1:])).ravel()
    value = sum(1 << int(i) for i in np.flatnonzero(bits))
    return value - (1 << 64) if value >> 63 else value


def block_mean(gray: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """Area-weighted reduction to rows x columns."""

    def weights(n: int, m: int) -> np.ndarray:
        edges = np.linspace(0, n, m + 1)
        i = np.arange(n)
        part = np.clip(np.minimum(edges[1:, None], i[None] + 1) - np.maximum(edges[:-1, None], i[None]), 0, None)
        return part / part.sum(1, keepdims=True)

    return weights(gray.shape[0], rows) @ gray.astype(np.float64) @ weights(gray.shape[1], columns).T


def pixel_fidelity(a: np.ndarray, b: np.ndarray) -> float:
    """1 - mean absolute difference over 255."""
    return float(1 - np.abs(a.astype(np.float64) - b).mean() / 255)


def feather_mask(height: int, width: int, ratio: float = 0.20) -> np.ndarray:
    """1 inside, falling to 0 at the border over a share of each side: a blurred frame of zeros."""
    sides = []
    for n in (height, width):
        k = max(int(n * ratio) | 1, 5)
        line = np.ones(n)
        line[: k // 2] = line[n - k // 2 :] = 0
        sigma = 0.3 * ((k - 1) * 0.5 - 1) + 0.8
        x = np.arange(k) - k // 2
        g = np.exp(-(x**2) / (2 * sigma**2))
        sides.append(np.convolve(np.pad(line, k // 2, mode="reflect" if n > k // 2 else "edge"), g / g.sum(), "valid"))
    return np.outer(*sides)


def blend(original: np.ndarray, restored: np.ndarray, x: int, y: int, ratio: float = 0.20) -> np.ndarray:
    """``restored`` laid over ``original`` at (x, y) with a feathered border."""
    h, w = restored.shape[:2]
    mask = feather_mask(h, w, ratio)
    if original.ndim == 3:
        mask = mask[..., None]
    out = original.copy()
    part = out[y : y + h, x : x + w].astype(np.float64)
    out[y : y + h, x : x + w] = np.clip(part * (1 - mask) + restored * mask, 0, 255).astype(original.dtype)
    return out


def pixels_udf(kernel: Callable[[np.ndarray], dict[str, float]], fields: str) -> Callable[[Column, int], Column]:
    """An Arrow UDF that applies a kernel to flat pixel arrays of a given width; failures give null and their message in ``error``."""

    def build(pixels: Column, width: int) -> Column:
        names = [f.split()[0] for f in fields.split(", ")]

        @F.pandas_udf(f"{fields}, error string")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for flat in batch:
                    try:
                        rows.append({**kernel(np.asarray(flat, dtype=np.float64).reshape(-1, width)), "error": None})
                    except Exception as e:  # noqa: BLE001 - the row keeps the message
                        rows.append({**dict.fromkeys(names), "error": str(e)[:200]})
                yield pd.DataFrame(rows, columns=[*names, "error"])

        return run(pixels)

    return build


TECHNICAL_FIELDS = "laplacian_score double, tenengrad_score double, brightness_mean double, brightness_std double, shadow_pixel_ratio double, highlight_pixel_ratio double, contrast_p90_p10 double"
technical_metrics_udf = pixels_udf(technical_metrics, TECHNICAL_FIELDS)


# Numbers of the face-mesh points of a head pose (nose, chin, outer eye corners, mouth corners) and where they lie on a model head.
POSE_POINTS = (1, 152, 33, 263, 61, 291)
MODEL_HEAD = ((0.0, 0.0, 0.0), (0.0, -330.0, -65.0), (-225.0, 170.0, -135.0), (225.0, 170.0, -135.0), (-150.0, -150.0, -125.0), (150.0, -150.0, -125.0))


def _turn(v: np.ndarray) -> np.ndarray:
    """Rotation matrix of an axis times its angle."""
    angle = np.linalg.norm(v)
    if angle < 1e-12:
        return np.eye(3)
    x, y, z = v / angle
    k = np.array([[0, -z, y], [z, 0, -x], [-y, x, 0]])
    return np.eye(3) + math.sin(angle) * k + (1 - math.cos(angle)) * k @ k


def _solve_view(model: np.ndarray, seen: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray] | None:
    """Rotation and shift under which a camera of focal length 1 sees the model's points at ``seen``: a linear solution, then damped least squares."""
    scale = np.abs(model).max()
    full = np.c_[model / scale, np.ones(len(model))]
    rows = np.zeros((2 * len(model), 12))
    rows[0::2, 0:4], rows[0::2, 8:12] = full, -seen[:, :1] * full
    rows[1::2, 4:8], rows[1::2, 8:12] = full, -seen[:, 1:] * full
    p = np.linalg.svd(rows)[2][-1].reshape(3, 4)
    u, size, vt = np.linalg.svd(p[:, :3])
    if size.mean() < 1e-12:
        return None
    p = p * (np.sign(np.linalg.det(p[:, :3])) or 1.0) / size.mean()
    u, _, vt = np.linalg.svd(p[:, :3])
    r, t = u @ np.diag([1.0, 1.0, np.linalg.det(u @ vt)]) @ vt, p[:, 3] * scale

    def miss(r: np.ndarray, t: np.ndarray) -> np.ndarray:
        q = model @ r.T + t
        return (q[:, :2] / q[:, 2:] - seen).ravel()

    damp, now = 1e-3, miss(r, t)
    for _ in range(rounds):
        steps = np.r_[np.full(3, 1e-6), np.full(3, scale * 1e-6)]
        jacobian = np.stack([(miss(_turn(d[:3]) @ r, t + d[3:]) - now) / d.sum() for d in np.diag(steps)], axis=1)
        normal = jacobian.T @ jacobian
        step = np.linalg.lstsq(normal + damp * np.diag(np.diag(normal)), -jacobian.T @ now, rcond=None)[0]
        tried = (_turn(step[:3]) @ r, t + step[3:])
        then = miss(*tried)
        if then @ then < now @ now:
            (r, t), damp, close = tried, damp / 10, now @ now - then @ then < 1e-18
            now = then
            if close:
                break
        else:
            damp *= 10
            if damp > 1e6:
                break
    return r, t


def head_pose(landmarks: list[tuple[float, float]] | None, width: int, height: int) -> tuple[float, float, float] | None:
    """Yaw, pitch (folded into [-90, 90]) and roll in degrees from face-mesh points in shares of the picture, for a camera as long as the picture is wide; None without a face or solution."""
    if landmarks is None:
        return None
    at = np.array([(landmarks[i][0] * width, landmarks[i][1] * height) for i in POSE_POINTS])
    found = _solve_view(np.array(MODEL_HEAD), (at - [width / 2, height / 2]) / width) if np.isfinite(at).all() else None
    if found is None or not np.isfinite(found[0]).all():
        return None
    r = found[0]
    pitch = math.degrees(math.atan2(r[2, 1], r[2, 2]))
    yaw, roll = math.degrees(math.atan2(-r[2, 0], math.hypot(r[2, 1], r[2, 2]))), math.degrees(math.atan2(r[1, 0], r[0, 0]))
    return yaw, (180 - pitch if pitch > 90 else -180 - pitch if pitch < -90 else pitch), roll


def head_pose_udf(landmarks: Column, width: Column, height: Column) -> Column:
    """:func:`head_pose` of arrays of (x, y) arrays as a struct of pose_yaw, pose_pitch, pose_roll and pose_error, by Arrow batches."""

    @F.pandas_udf("pose_yaw double, pose_pitch double, pose_roll double, pose_error string")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for points, w, h in zip(*batch):
                try:
                    got = head_pose(None if points is None else [(float(x), float(y)) for x, y in points], int(w), int(h))
                    rows.append((*got, None) if got else (None, None, None, "no face"))
                except Exception as e:  # noqa: BLE001 - the row keeps the message
                    rows.append((None, None, None, str(e)[:200]))
            yield pd.DataFrame(rows, columns=["pose_yaw", "pose_pitch", "pose_roll", "pose_error"])

    return run(landmarks, width, height)


def _face_measures(plane: dict[str, np.ndarray], points: list[tuple[float, float]] | None, box: tuple[int, int, int, int]) -> dict[str, float]:
    left, right = eye_presence(plane["saturation"], plane["value"], points)
    eyes, mouth = anatomical_sharpness(plane["gray"], points)
    texture, plasticity = cheek_texture(plane["gray"], points, box, eyes)
    values = (left, right, eyes, mouth, texture, plasticity, central_gradient(plane["gray"], points))
    return dict(zip(FACE_FIELDS, values))


FACE_FIELDS = ("left_eye_presence_ratio", "right_eye_presence_ratio", "eye_sharpness", "mouth_sharpness", "skin_texture_score", "plasticity_ratio", "face_central_gradient")


def face_measures_udf(gray: Column, saturation: Column, value: Column, width: Column, landmarks: Column, box: Column) -> Column:
    """Eye presence, eye and mouth sharpness, cheek texture, plasticity and central gradient of a picture, by Arrow batches.

    ``gray``, ``saturation`` and ``value`` are flat pixel arrays of rows of ``width``; ``landmarks`` is an array of (x, y) arrays in shares of the picture, null without a
    mesh; ``box`` the face's (x, y, width, height). The eyes' validity is decided later by ``gate.eyes_valid``. A picture that cannot be read gives nulls and its message in ``error``.
    """

    @F.pandas_udf(", ".join(f"{f} double" for f in FACE_FIELDS) + ", error string")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for g, s, v, w, points, b in zip(*batch):
                try:
                    plane = {n: np.asarray(x, dtype=np.float64).reshape(-1, int(w)) for n, x in (("gray", g), ("saturation", s), ("value", v))}
                    rows.append({**_face_measures(plane, None if points is None else [(float(x), float(y)) for x, y in points], tuple(map(int, b))), "error": None})
                except Exception as e:  # noqa: BLE001 - the row keeps the message
                    rows.append({**dict.fromkeys(FACE_FIELDS), "error": str(e)[:200]})
            yield pd.DataFrame(rows, columns=[*FACE_FIELDS, "error"])

    return run(gray, saturation, value, width, landmarks, box)


def _missing(name: str, need: str):
    def call(*_args, **_kwargs):
        raise ModelRequired(f"{name} needs {need}; join its output as a column instead")

    return call


decode_image = _missing("decode_image", "an image decoder")
face_landmarks = _missing("face_landmarks", "a face mesh model")
face_embedding = _missing("face_embedding", "a vision transformer")
clip_attributes = _missing("clip_attributes", "an image-text model")
restore_face = _missing("restore_face", "a face restoration model")
