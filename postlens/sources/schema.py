"""Schemas of the inputs and of the tables the jobs exchange."""

from __future__ import annotations

# Only the fields the jobs read. Naming them spares the extra pass over the
# input that schema inference would cost.
RAW_POST = (
    "id bigint, created_at string, text string, lang string, "
    "in_reply_to_user_id bigint, retweet_count bigint, favorite_count bigint, "
    "entities struct<hashtags: array<struct<text: string>>>, "
    "user struct<id: bigint, id_str: string, screen_name: string, description: string, "
    "created_at: string, followers_count: bigint>, "
    "retweeted_status struct<id: bigint, user: struct<id: bigint, id_str: string, "
    "screen_name: string, description: string, created_at: string>>"
)

CONTACT_RANKING = (
    "rank int, user2_id bigint, screen_name string, description string, "
    "text string, phrase_hits bigint, score double"
)
TOPIC_WORD_RANKING = "rank int, word string, shown_word string, posts bigint, score double"
TOPIC_POST_RANKING = "rank int, post_id bigint, impact bigint, text string"
