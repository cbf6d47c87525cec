"""The two ingestion profiles and their fixed values.

``BATCH`` is the two-file pipeline, ``APP`` the interactive paths (uploads, datasets,
web pages, manual entries). They share every operator and differ only in this data.
"""

from __future__ import annotations

from dataclasses import dataclass

# Labels and default texts.
POSITIVE, NEGATIVE, NEUTRAL = "Positive", "Negative", "Neutral"
NO_TEXT_REASON = "No Review Provided"
DEFAULT_CATEGORY = "General Electronics"
BLANK_PLACEHOLDER = "No Review"
ECOMMERCE_SOURCE = "E-Commerce Dataset"
CLOTHING_SOURCE = "Womens Clothing Dataset"
MANUAL_SOURCE = "Manual Entry"


@dataclass(frozen=True)
class Profile:
    """Rules and lists of one ingestion path."""

    name: str
    negative_rules: tuple[tuple[str, tuple[str, ...]], ...]
    negative_default: str
    other_rules: tuple[tuple[str, tuple[str, ...]], ...]
    other_default: str
    advice: tuple[tuple[str, str], ...]
    default_advice: str
    brands: tuple[str, ...]
    product_keys: tuple[str, ...]

    @property
    def is_batch(self) -> bool:
        return self.name == "batch"


# Keywords per reason, in priority order.
BATCH = Profile(
    name="batch",
    negative_rules=(
        ("Hardware and Power Issues", ("battery", "charger", "power", "cord", "plug")),
        (
            "Logistics and Shipping Delay",
            ("delivery", "shipping", "shipped", "days", "took", "merchant", "receive"),
        ),
        (
            "Product Sizing and Fit Defect",
            ("fit", "size", "tight", "small", "large", "xs", "medium", "cut", "fabric"),
        ),
        (
            "Product Quality and Build Material",
            ("broken", "peeling", "cheap", "flimsy", "trash", "junk", "worst", "rubbish"),
        ),
        (
            "Software Interface Bug",
            ("menu", "scrolling", "scroll", "buttons", "software", "app", "crash"),
        ),
    ),
    negative_default="General Product Dissatisfaction",
    other_rules=(
        (
            "High Customer Satisfaction",
            ("love", "great", "excellent", "wonderful", "amazing", "best", "perfect"),
        ),
    ),
    other_default="Positive User Feedback",
    # Advice texts.
    advice=(
        (
            "Hardware and Power Issues",
            "Enhance hardware battery capacity and optimize power firmware.",
        ),
        (
            "Logistics and Shipping Delay",
            "Optimize last-mile logistics networks and review courier partner SLAs.",
        ),
        (
            "Product Sizing and Fit Defect",
            "Update digital size charts and refine manufacturing dimensional alignment.",
        ),
        (
            "Product Quality and Build Material",
            "Conduct rigorous vendor component selection and quality control audits.",
        ),
        (
            "Software Interface Bug",
            "Prioritize checkout and user interface hotfixes in the next software release.",
        ),
        (
            "General Product Dissatisfaction",
            "Initiate direct customer outreach to gather detailed feedback points.",
        ),
        (
            "High Customer Satisfaction",
            "Maintain current operational excellence standards and leverage for testimonial marketing.",
        ),
        (
            "Positive User Feedback",
            "Incorporate user highlights into upcoming marketing collateral.",
        ),
    ),
    default_advice="Monitor customer feedback trends for continuous improvement.",
    # Brands in the order of the hash.
    brands=("LogiTech", "Sony", "Anker", "Apple", "Samsung", "Wrangler", "General Brands"),
    product_keys=("product_name", "category"),
)

# Keywords per reason, in priority order.
APP = Profile(
    name="app",
    negative_rules=(
        ("Hardware and Power Issues", ("battery", "charger", "power", "cord", "plug")),
        (
            "Logistics and Shipping Delay",
            ("delivery", "shipping", "shipped", "days", "took", "merchant"),
        ),
        (
            "Product Sizing and Fit Defect",
            ("fit", "size", "tight", "small", "large", "fabric"),
        ),
        (
            "Product Quality and Build Material",
            ("broken", "peeling", "cheap", "flimsy", "trash", "junk"),
        ),
        ("Software Interface Bug", ("menu", "scroll", "buttons", "software", "crash")),
    ),
    negative_default="General Product Dissatisfaction",
    other_rules=(
        (
            "High Customer Satisfaction",
            ("love", "great", "excellent", "wonderful", "amazing"),
        ),
    ),
    other_default="Positive User Feedback",
    # Advice texts.
    advice=(
        (
            "Hardware and Power Issues",
            "Enhance hardware battery capacity and optimize power firmware.",
        ),
        (
            "Logistics and Shipping Delay",
            "Optimize last-mile logistics networks and review SLAs.",
        ),
        (
            "Product Sizing and Fit Defect",
            "Update digital size charts and refine manufacturing dimensions.",
        ),
        (
            "Product Quality and Build Material",
            "Conduct rigorous vendor quality control audits.",
        ),
        (
            "Software Interface Bug",
            "Prioritize user interface hotfixes in the next software release.",
        ),
        (
            "General Product Dissatisfaction",
            "Initiate direct customer outreach to gather feedback.",
        ),
        (
            "High Customer Satisfaction",
            "Leverage for testimonial marketing and loyalty programs.",
        ),
        (
            "Positive User Feedback",
            "Incorporate user highlights into marketing collateral.",
        ),
    ),
    default_advice="Monitor customer feedback trends.",
    # Brands in the order of the hash.
    brands=("LogiTech", "Sony", "Anker", "Apple", "Samsung", "Wrangler"),
    product_keys=("product_name",),
)

# Countries by index, and each country's cities by index.
LOCATIONS = (
    ("United States", ("New York", "Los Angeles", "Chicago")),
    ("United Kingdom", ("London", "Manchester", "Birmingham")),
    ("Egypt", ("Cairo", "Alexandria", "Giza")),
    ("Canada", ("Toronto", "Vancouver", "Montreal")),
    ("Germany", ("Berlin", "Munich", "Frankfurt")),
)
