"""The message topic, read and written as a bounded batch."""

from farelake.streaming.topic import (
    MESSAGE,
    FileTopic,
    KafkaTopic,
    Topic,
    decode,
    decode_trips,
    encode,
    last_of_each_key,
    message_key,
    peek,
    trip_messages,
)

__all__ = [
    "MESSAGE",
    "FileTopic",
    "KafkaTopic",
    "Topic",
    "decode",
    "decode_trips",
    "encode",
    "last_of_each_key",
    "message_key",
    "peek",
    "trip_messages",
]
