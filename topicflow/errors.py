"""Errors raised by topicflow."""


class TopicflowError(Exception):
    """Base class."""


class UnknownTopic(TopicflowError):
    """The topic was never created."""


class TopicExists(TopicflowError):
    """The topic exists with another schema."""


class InvalidName(TopicflowError):
    """A topic, producer, subscription or column name that cannot be used."""


class SchemaMismatch(TopicflowError):
    """Rows do not have the topic's columns, order and types."""


class StaleBatch(TopicflowError):
    """A new batch id at or below the producer's newest one."""


class InvalidSubscription(TopicflowError):
    """The subscription is unknown or has ended."""


class PushFailed(TopicflowError):
    """A packet could not be delivered within the allowed attempts."""


class NoSharedFolder(TopicflowError):
    """Intermediate data needs a folder that all executors can reach, and none is named."""


class ReleasedBatches(TopicflowError):
    """A stream would have to read batches that were released before it came to them."""
