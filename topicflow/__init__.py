"""Exchange tables and streams through named, typed topics. Everything runs as Spark jobs."""

import sys

from pyspark import cloudpickle

from topicflow.errors import TopicflowError
from topicflow.space import TopicSpace

__all__ = ["TopicSpace", "TopicflowError"]

# functions sent to executors carry their code along, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
