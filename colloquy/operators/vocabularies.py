"""Controlled vocabularies of the client domain."""

# The labels that answers may hold, as they are written in stored rows.
CHALLENGES = (
    "Diversify product & services",
    "Expand locations",
    "Succession planning",
    "Shrinking margin",
    "Spikes in workload",
    "Losing revenue cos lack of staff",
    "Needing specialists in short notice",
    "Maintaining creative quality without ballooning overheads",
    "Margins eroding as business scales",
    "Misalignment between creating value and delivering value",
    "Unsure how to value their business",
    "Not knowing which businesses are right to buy / acquire",
    "Lacking intros to PE or M&A firms",
    "Missing out on growth opportunities as they can't move fast enough",
    "Don't have networks in specific locations",
    "Diversify product",
    "Consolidating agencies",
    "Elevating creativity",
)
RESULTS = (
    "Revenue Growth",
    "Win rate on pitches %",
    "Access to new markets and clients",
    "Ability to take on more complex higher margin work",
    "Lower fixed cost base through flexible talent models",
    "More profit per head",
    "Reduced talent churn",
    "Reduced inefficiencies",
    "Avoiding mishires",
    "Avoiding stagnancy",
    "Smooth succession protecting value and continuity",
    "Built proprietary products that lead to higher valuations",
    "Faster hiring in scarce talent pools",
    "Foresight of costs with flexible talent models",
    "Foresight of resource with always-on talent",
    "Scaled systems that mean we focus on compounding our strengths",
    "Won industry accolades",
    "Increased quality of output meaning more client wins",
    "Stronger brand reputation and client stickiness",
    "Stronger employer brand reputation and talent stickiness",
    "Distinctive talent advantage that competitors can't replicate easily",
)
OFFERINGS = (
    "Creative & Design",
    "Branding Consultancy",
    "Product",
    "Content Studio",
    "Production Company",
    "Influencer / Creator agency",
    "Media",
    "Performance Marketing",
    "PR / Comms",
    "Experiential",
    "Social",
    "Innovation",
    "Data",
    "E-Commerce",
    "AI Automation",
    "Brand",
    "Health & Pharma",
    "B2B",
    "Sports & Entertainment",
    "Sustainability agency",
    "Luxury & Fashion",
    "Gaming",
    "Fintech",
    "Other",
)
