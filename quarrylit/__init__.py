"""Literature-metadata extraction as DataFrames."""
