"""Dataset curation for object detection, as Spark DataFrame operators."""
