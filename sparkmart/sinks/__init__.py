"""Writers: topics, dimension tables, statistics, raw landing."""
