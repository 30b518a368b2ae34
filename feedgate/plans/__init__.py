"""The steps put together: a lazy plan and a materialised build."""
