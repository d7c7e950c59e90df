"""Where the given tables are."""

SF = "/root/testdata/sf0.001"
SF_MORE = "/root/testdata/sf0.01"
