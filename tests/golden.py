"""Golden values of the sample article and its published summary (fixture spec).

Fixed values: the article's text, its eleven scores, and the expected selection and summary.
"""

ARTICLE = (
    "A team of researchers announced a significant breakthrough in renewable energy storage this week, "
    "unveiling a battery prototype that could dramatically extend the lifetime and efficiency of grid-scale "
    "storage systems. The prototype, developed over three years of research, uses a novel chemistry that "
    "reduces degradation and allows more charge-discharge cycles than conventional lithium-ion cells. Early "
    "tests indicate the new cells can retain over 90% of their capacity after tens of thousands of cycles, a "
    "performance metric that, if replicated at scale, would lower long-term replacement costs for utilities.\n\n"
    "Industry analysts say the implications for renewable integration are substantial: cheaper, longer-lasting "
    "storage reduces reliance on fossil-fuel peaker plants and smooths the intermittency of solar and wind "
    "power. The research team emphasized that manufacturing challenges remain, including sourcing sustainable "
    "raw materials and adapting production lines to the new chemistry. They are partnering with several "
    "manufacturers to run pilot production tests and to evaluate lifecycle environmental impacts.\n\n"
    "Policy makers at a recent energy summit highlighted the technology as a potential game-changer for "
    "meeting national decarbonization targets. However, some experts urge caution, noting that lab and pilot "
    "success does not always translate to rapid commercial deployment. Financing, regulatory approvals, and "
    "supply chain logistics all play critical roles in moving from prototype to pervasive field deployment.\n\n"
    "Meanwhile, other efforts continue to advance complementary technologies—such as improved grid "
    "software for demand response and modular microgrids for rural electrification—that together with "
    "better storage could accelerate a transition to cleaner electricity systems. The research team plans to "
    "publish detailed performance data in a peer-reviewed journal within the next few months and to release "
    "an open dataset of test results to encourage independent verification and further innovation."
)

SCORES = [0.5546875, 0.53515625, 0.55078125, 0.640625, 0.5, 0.4296875, 0.43359375, 0.421875,
          0.46484375, 0.515625, 0.51171875]
SELECTED = [0, 2, 3]
SELECTED_SENTENCES = [
    "A team of researchers announced a significant breakthrough in renewable energy storage this week, "
    "unveiling a battery prototype that could dramatically extend the lifetime and efficiency of grid-scale "
    "storage systems.",
    "Early tests indicate the new cells can retain over 90% of their capacity after tens of thousands of "
    "cycles, a performance metric that, if replicated at scale, would lower long-term replacement costs for "
    "utilities.",
    "Industry analysts say the implications for renewable integration are substantial: cheaper, "
    "longer-lasting storage reduces reliance on fossil-fuel peaker plants and smooths the intermittency of "
    "solar and wind power.",
]
SUMMARY = " ".join(SELECTED_SENTENCES)
