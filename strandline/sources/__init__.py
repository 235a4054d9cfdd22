"""Sources: files of scenes, regions and series as DataFrames with fixed schemas."""
