"""Template captions and tag lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phrases by shot type and pose bucket, and the phrases of each attribute.
SHOT_PHRASES = {"CLOSE_UP": "extreme close-up portrait of", "UPPER_BODY": "upper body portrait of", "FULL_BODY": "full body wide shot of"}
SHOT_DEFAULT = "photograph of"
POSE_PHRASES = {
    "FRONT": "facing forward towards camera",
    "LEFT_3Q": "turned slightly in three-quarter view to the left",
    "RIGHT_3Q": "turned slightly in three-quarter view to the right",
    "LEFT_PROFILE": "in full left side profile view",
    "RIGHT_PROFILE": "in full right side profile view",
    "LOOKING_DOWN": "looking gently downward with lowered gaze",
    "LOOKING_UP": "looking slightly upward towards light",
    "EXTREME_POSE": "dynamic candid angle",
}
POSE_DEFAULT = "natural candid pose"
ATTRIBUTES = ("expression", "clothing", "hair", "bg", "lighting")
SUBJECT = "a young woman"
CAPTION_END = "high detail, authentic raw skin texture, 8k photo"
TAG_START = "1girl, solo"
TAG_END = "photorealistic"

# The phrases among which an image-text model chooses, per attribute.
PROMPTS = {
    "clothing": (
        "wearing an elegant black evening dress", "wearing a stylish black top", "wearing a casual white t-shirt", "wearing a warm knitted sweater", "wearing a denim jacket and pants",
        "wearing an oversized comfortable hoodie", "wearing a floral summer dress", "wearing casual modern streetwear", "wearing athletic sportswear", "wearing stylish casual clothes",
    ),
    "hair": (
        "long dark hair falling over shoulders", "hair tied up in a neat ponytail", "hair styled in a messy bun", "wavy brunette hair with natural texture", "sleek straight dark hair", "short bob hairstyle", "natural textured hair",
    ),
    "expression": (
        "gentle warm smile looking at camera", "subtle cheerful smile", "calm neutral expression with soft gaze", "serious focused expression", "candid smiling laughter", "pensive contemplative look",
    ),
    "bg": (
        "clean modern indoor apartment with soft interior", "cozy living room with warm wooden furniture", "bright contemporary room with white minimalist background", "urban city street with subtle bokeh",
        "outdoor cafe patio with natural ambiance", "studio environment with neutral clean background", "sunlit room with window shadows in background",
    ),
    "lighting": (
        "soft diffused natural daylight", "warm cinematic indoor ambient lighting", "soft golden hour sunlight with gentle shadows", "clean professional studio lighting", "cool atmospheric interior lighting", "bright airy window light",
    ),
}


def lookup(key: Column, table: dict, default) -> Column:
    """Value of a small fixed table, ``default`` for other keys and null."""
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def caption(trigger: str, shot: Column, pose: Column, attributes: dict[str, Column]) -> Column:
    """One sentence: framing, trigger, pose, then the attributes."""
    parts = [F.concat_ws(" ", lookup(shot, SHOT_PHRASES, SHOT_DEFAULT), F.lit(trigger)), F.lit(SUBJECT), lookup(pose, POSE_PHRASES, POSE_DEFAULT)]
    return F.concat_ws(", ", *parts, *[attributes[a] for a in ATTRIBUTES], F.lit(CAPTION_END))


def spoken(name: Column) -> Column:
    """An enumeration value in words: lower case, blanks for underscores."""
    return F.translate(F.lower(name), "_", " ")


def tags(trigger: str, shot: Column, pose: Column, attributes: dict[str, Column]) -> Column:
    return F.concat_ws(", ", F.lit(trigger), F.lit(TAG_START), spoken(shot), spoken(pose), *[attributes[a] for a in ATTRIBUTES], F.lit(TAG_END))


def best_label(scores: Column, labels: list[str]) -> Column:
    """Label of the greatest of an array of scores (first of equals): the argmax step of a zero-shot classifier."""
    return F.element_at(F.array(*map(F.lit, labels)), F.array_position(scores, F.array_max(scores)).cast("int"))


def best_attributes(scores: dict[str, Column]) -> dict[str, Column]:
    """The phrase of each attribute from a model's scores, one array per attribute in the order of PROMPTS; null without scores."""
    return {a: best_label(scores[a], list(PROMPTS[a])) for a in PROMPTS if a in scores}
