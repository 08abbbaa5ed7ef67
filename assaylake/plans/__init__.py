"""The operators put together: raw to trusted, trusted to refined, refined to models and scores."""
