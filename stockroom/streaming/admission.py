"""How much a micro-batch waits for and takes in."""

from __future__ import annotations

from dataclasses import dataclass

from stockroom.sources.topics import Topic


@dataclass(frozen=True)
class Admission:
    """Collect small arrivals into larger writes.

    A batch starts every ``every_seconds`` once ``min_rows`` have arrived or ``max_seconds`` have passed, and takes at
    most ``max_rows``; a folder source limits by files or bytes instead. Defaults are fixed values of the buffered
    table this replaces. Raise ``max_rows`` with the cluster: it bounds a batch, not the result.
    """

    every_seconds: int = 10
    max_seconds: int = 100
    min_rows: int = 10_000
    max_rows: int = 1_000_000
    max_bytes: int | None = 100_000_000
    max_files: int | None = None

    def apply(self, topic: Topic) -> Topic:
        if topic.format == "kafka":
            return topic.limited(
                minOffsetsPerTrigger=self.min_rows,
                maxTriggerDelay=f"{self.max_seconds}s",
                maxOffsetsPerTrigger=self.max_rows,
            )
        if self.max_files is not None:
            return topic.limited(maxFilesPerTrigger=self.max_files)
        return topic.limited(maxBytesPerTrigger=self.max_bytes) if self.max_bytes else topic

    def limit(self, topic: Topic) -> Topic:
        """Only what a batch takes at most; it does not wait for more to arrive."""
        if topic.format == "kafka":
            return topic.limited(maxOffsetsPerTrigger=self.max_rows)
        return self.apply(topic)

    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{self.every_seconds} seconds"}


# The interval at which the item stream is polled, and draining what is there and then stopping.
EVERY_SECOND = {"processingTime": "1 seconds"}
UNTIL_DRAINED = {"availableNow": True}
