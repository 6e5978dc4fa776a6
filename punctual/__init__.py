"""Order-punctuality marts, quality gates and BI layer on Spark."""
