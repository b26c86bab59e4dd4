"""Reading topic logs (by position, time, topic) and repeatable generators."""
