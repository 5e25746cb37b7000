import pytest
from examples import FIVE, frame, image, message, text
from pyspark.sql import functions as F

from stepmark.functions.text import tokenize_text
from stepmark.operators import messages as M


def apply(spark, messages, column, images=None):
    return frame(spark, [(1, images, messages)]).select(column.alias("x")).first()["x"]


def shape(messages):
    """Role and items of each message as (type, value)."""
    return [
        (m["role"], [(i["type"], i["text"] if i["type"] == "text" else i["image"]) for i in m["content"]])
        for m in messages
    ]


def clean():
    return M.clean_items_media_first(F.col("messages"))


def resolve():
    return M.resolve_image_index(F.col("messages"), F.col("images"))


def test_clean_puts_media_first_and_keeps_empty_text(spark):
    other = {"type": "video", "text": "x", "image": "y", "index": None}
    got = apply(spark, [message("user", text("a"), image("i"), text(None), image(None), text(""), other)], clean())
    assert shape(got) == [("user", [("image", "i"), ("text", "a"), ("text", "")])]


def test_clean_keeps_only_the_key_of_the_type(spark):
    both = {"type": "text", "text": "a", "image": "i", "index": 3}
    item = apply(spark, [message("user", both)], clean())[0]["content"][0]
    assert (item["text"], item["image"], item["index"]) == ("a", None, None)


def test_messages_without_usable_items_are_dropped(spark):
    messages = [message("system", text(None)), message("user"), message("user", image("i")), message("assistant", text(""))]
    got = apply(spark, messages, M.drop_empty_messages(F.col("messages")))
    assert [m["role"] for m in got] == ["user", "assistant"]


def test_resolve_keeps_order_and_defaults_to_the_first_image(spark):
    messages = [message("user", text("a"), image(index=1), text("b"), image(index=None))]
    got = apply(spark, messages, resolve(), ["p", "q"])
    assert shape(got) == [("user", [("text", "a"), ("image", "q"), ("text", "b"), ("image", "p")])]


@pytest.mark.parametrize("images, index", [(["p"], 1), (["p"], -1), ([], 0), (None, 0)])
def test_resolve_drops_items_without_image(spark, images, index):
    messages = [message("user", image(index=index)), message("user", text("a"), image(index=index))]
    assert shape(apply(spark, messages, resolve(), images)) == [("user", [("text", "a")])]


def test_dropped_index_report(spark):
    df = frame(spark, [
        (1, ["p"], [message("user", text("a"), image(index=2)), message("user", image())]),
        (2, [], [message("user", image())]),
    ])
    got = sorted(tuple(r) for r in M.dropped_index_report(df, "id").collect())
    assert got == [(1, 0, 1, 2), (2, 0, 0, 0)]


def test_flatten_images(spark):
    messages = [message("user", image("b"), text("x"), image("a")), message("user", image(None)), message("user", image("b"))]
    assert apply(spark, messages, M.flatten_message_images(F.col("messages"))) == ["b", "a", "b"]


def test_render(spark):
    messages = [message("user", image("p"), text("hi")), message("assistant", text("<+>"))]
    default = apply(spark, messages, M.render_chat(F.col("messages")))
    assert default == "<|user|>\n<image>hi<|end|>\n<|assistant|>\n<+><|end|>\n"
    own = M.ChatTemplate(head="[{role}] ", tail="\n", image="IMG ")
    assert apply(spark, messages, M.render_chat(F.col("messages"), own, strip=True)) == "[user] IMG hi\n[assistant] <+>"


def test_five_messages_have_one_good_and_one_bad_mark(spark):
    tokens = tokenize_text(M.render_chat(M.drop_empty_messages(clean())))
    got = apply(spark, FIVE, tokens)
    assert got.count("<+>") == 1 and got.count("<->") == 1 and got.count("<image>") == 1
