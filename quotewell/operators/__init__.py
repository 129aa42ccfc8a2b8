"""DataFrame-to-DataFrame operators.

Windows over a share (or series, or company) are used only on tables that are unique per
(key, day). Such a group can hold no more rows than the calendar has days - about 9,000 for 25
years - however skewed the raw data is. Tables without that guarantee are reduced by
aggregates, which combine on the map side before any shuffle.
"""
