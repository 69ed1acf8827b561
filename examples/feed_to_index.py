"""Example: a Kafka feed through the histogram analyzer into a search index.

Needs the Kafka and index connector jars on the classpath, e.g.
``spark-submit --packages <kafka connector>,<index connector> examples/feed_to_index.py``.
Arguments: brokers topics index mapping field [index-nodes] [index-port].
"""

import sys

from flowdex.plans.analyzers import HistogramAnalyzer
from flowdex.session import build_session, named_dir
from flowdex.sinks.index import CONNECTOR_FORMAT, index_options, index_sink
from flowdex.sources.feeds import kafka_source_options, open_kafka_feed
from flowdex.streaming.runner import start_indexing, trigger_of


def main(argv):
    brokers, topics, index, mapping, field = argv[:5]
    nodes = argv[5] if len(argv) > 5 else "localhost"
    port = argv[6] if len(argv) > 6 else "9200"
    spark = build_session()
    feed = open_kafka_feed(spark, kafka_source_options(brokers, topics=topics, max_offsets=10_000_000))
    analyzer = HistogramAnalyzer(field, named_dir(spark, "logs", "state"), keep=["record_id"])
    # Written by record id, a batch that is replayed after a failure replaces its own documents.
    sink = index_sink("", id_col="record_id", fmt=CONNECTOR_FORMAT,
                      options=index_options(nodes, port, index, mapping, id_col="record_id"))
    query = start_indexing(feed, analyzer, sink, named_dir(spark, "logs", "checkpoint"),
                           trigger=trigger_of(spark=spark))
    query.awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
