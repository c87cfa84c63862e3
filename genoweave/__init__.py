"""Spark-native comparative-genomics analytics: orthologs, synteny, layout, text sources and sinks."""
