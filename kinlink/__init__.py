"""Record linkage and text-corpus analytics expressed as Spark DataFrame plans."""
