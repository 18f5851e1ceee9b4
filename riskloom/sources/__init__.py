"""Raw CSV scan, the partitioned lake, and demo views over the TPC-H-like tables."""
