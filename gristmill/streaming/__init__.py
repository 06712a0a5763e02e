"""Structured Streaming jobs. Every batch writes its own folder, so a repeated batch replaces itself."""
