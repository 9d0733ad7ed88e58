"""The test tables in the shape of the sales exports, and the queries run on them."""
