"""Hand-written examples for the tests."""

from stepmark.schemas import MESSAGES


def text(value):
    return {"type": "text", "text": value, "image": None, "index": None}


def image(value=None, index=None):
    return {"type": "image", "text": None, "image": value, "index": index}


def message(role, *items):
    return {"role": role, "content": list(items)}


# Five messages with one image, one good and one bad step.
FIVE = [
    message("system", text("Judge each step.")),
    message("user", image("<image>"), text("Question: how many?\n<step_1>\nThere are two.\n</step_1>")),
    message("assistant", text("<+>")),
    message("user", text("<step_2>\nSo the answer is three.\n</step_2>")),
    message("assistant", text("<->")),
]


def frame(spark, rows):
    """(id, images, messages) from tuples."""
    schema = f"id bigint, images array<string>, messages {MESSAGES.simpleString()}"
    return spark.createDataFrame(rows, schema)
