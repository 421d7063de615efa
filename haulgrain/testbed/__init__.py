"""The supplied test tables seen as freight sources, and the queries checked on them."""
