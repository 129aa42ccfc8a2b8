"""quotewell: daily share quotes, macro series and company filings on Spark DataFrames."""
