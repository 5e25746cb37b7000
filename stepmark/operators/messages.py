"""Messages: cleaning, image index resolution, flattening, rendering. All row-local."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepmark.functions.text import IMAGE, trim_text
from stepmark.schemas import ITEM


def content_item(
    type_: str, text: Column | None = None, image: Column | None = None, index: Column | None = None
) -> Column:
    """An item with the given keys set and the others NULL."""
    values = {"type": F.lit(type_), "text": text, "image": image, "index": index}
    return F.struct(*[
        (F.lit(None) if values[f.name] is None else values[f.name]).cast(f.dataType).alias(f.name)
        for f in ITEM.fields
    ])


def _usable_text(item: Column) -> Column:
    return (item["type"] == "text") & item["text"].isNotNull()


def _usable_image(item: Column) -> Column:
    return (item["type"] == "image") & item["image"].isNotNull()


def clean_items_media_first(messages: Column) -> Column:
    """Usable items of each message, all images before all texts, each with its own key only.

    Usable: an image with a reference or a text that is not NULL (it may be empty).
    """

    def cleaned(message: Column) -> Column:
        content = message["content"]
        images = F.transform(F.filter(content, _usable_image), lambda i: content_item("image", image=i["image"]))
        texts = F.transform(F.filter(content, _usable_text), lambda i: content_item("text", text=i["text"]))
        return F.struct(message["role"].alias("role"), F.concat(images, texts).alias("content"))

    return F.transform(messages, cleaned)


def drop_empty_messages(messages: Column) -> Column:
    """Messages that have at least one usable item."""
    return F.filter(
        messages,
        lambda m: F.exists(m["content"], lambda i: _usable_text(i) | _usable_image(i)),
    )


def _image_at(images: Column, item: Column) -> Column:
    return F.get(images, F.coalesce(item["index"], F.lit(0)))


def resolve_image_index(messages: Column, images: Column) -> Column:
    """Image items point into `images` by index (default 0); item order is kept.

    An index without an image drops the item, and a message left without items is dropped.
    """

    def resolved(message: Column) -> Column:
        items = F.transform(
            message["content"],
            lambda i: F.when(_usable_text(i), content_item("text", text=i["text"])).when(
                i["type"] == "image", content_item("image", image=_image_at(images, i))
            ),
        )
        kept = F.filter(items, lambda i: i["text"].isNotNull() | i["image"].isNotNull())
        return F.struct(message["role"].alias("role"), kept.alias("content"))

    return F.filter(F.transform(messages, resolved), lambda m: F.size(m["content"]) > 0)


def dropped_index_report(df: DataFrame, key: str) -> DataFrame:
    """Image items whose index has no image: one row per item, with its place and index."""
    messages = df.select(key, "images", F.posexplode_outer("messages").alias("message_pos", "m"))
    items = messages.select(
        key, "images", "message_pos", F.posexplode_outer("m.content").alias("item_pos", "item")
    )
    return items.where((F.col("item.type") == "image") & _image_at(F.col("images"), F.col("item")).isNull()).select(
        key, "message_pos", "item_pos", F.coalesce("item.index", F.lit(0)).alias("image_index")
    )


def flatten_message_images(messages: Column) -> Column:
    """All image references of all messages, in order."""
    return F.flatten(
        F.transform(
            messages,
            lambda m: F.transform(F.filter(m["content"], lambda i: i["image"].isNotNull()), lambda i: i["image"]),
        )
    )


@dataclass(frozen=True)
class ChatTemplate:
    """How a message is written out. Model templates differ; pass your own.

    `head` and `tail` surround each message, `{role}` in `head` is replaced by the role.
    """

    head: str = "<|{role}|>\n"
    tail: str = "<|end|>\n"
    image: str = IMAGE


def render_chat(messages: Column, template: ChatTemplate = ChatTemplate(), strip: bool = False) -> Column:
    """One text per example: head, items in order, tail, for every message; no prompt at the end.

    A message without a role cannot be written and fails the job; NULL messages are left out.
    """
    before_role, _, after_role = template.head.partition("{role}")

    def item_text(item: Column) -> Column:
        return F.when(item["type"] == "image", F.lit(template.image)).otherwise(item["text"])

    def message_text(message: Column) -> Column:
        return F.concat(
            F.lit(before_role),
            F.when(message["role"].isNotNull(), message["role"]).when(message.isNotNull(), F.raise_error(F.lit("a message has no role"))),
            F.lit(after_role),
            F.array_join(F.transform(message["content"], item_text), ""),
            F.lit(template.tail),
        )

    text = F.array_join(F.transform(messages, message_text), "")
    return trim_text(text) if strip else text
